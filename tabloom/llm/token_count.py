"""Token counts of whole texts; huge ones are encoded in overlapping chunks and spliced.

A chunk boundary is only trusted where it is provably stable: a single space between two
characters that are not white space. The splitting pattern never lets a match run from a
non-space character across such a space, whatever stands further left, so a match starts at the
space both in the chunk and in the whole text, and no special token holds a space. Two
neighbouring chunks are spliced at the first stable place of their overlap where both encodings
start a token; where the overlap has none, it is doubled.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches

#: A single space between characters that are not white space (nor control characters).
_STABLE = re.compile(r"(?<=[^\s\x00-\x20\x7f-\xa0]) (?=[^\s\x00-\x20\x7f-\xa0])")
#: Characters in a chunk, and in the first overlap tried. Shorter texts are encoded at once.
CHUNK, OVERLAP = 1 << 16, 256
#: Texts encoded together.
BATCH_CHARS = 1 << 20


@lru_cache(maxsize=4)
def load(path: str):
    """An encoder for a .json file of `tokenizers` or a .model file of `sentencepiece`."""
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


def token_starts(tokenizer, text: str) -> list[int]:
    """Where each token starts, in characters. A leading space that the library leaves out of its offsets counts."""
    enc = tokenizer.encode(text, add_special_tokens=False)
    out, end = [], 0
    for a, b in enc.offsets:
        if a > end and text[end] == " ":
            a = end
        out.append(a)
        end = max(end, b)
    return out


def spliced_count(text: str, starts_of: Callable[[str], list[int]], chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of text, from chunks of `chunk` characters that overlap their successors."""
    n, begin, total = len(text), 0, 0
    while begin < n:
        if n - begin <= chunk + overlap:
            return total + len(starts_of(text[begin:]))
        wide = overlap
        while True:
            cut = begin + chunk
            stop = min(n, cut + wide)
            left = starts_of(text[begin:stop])
            if stop == n:
                return total + len(left)
            # The last characters of a chunk may be encoded otherwise than in the whole text.
            right = starts_of(text[cut : min(n, stop + wide)])
            known_left = {begin + x for x in left}
            known_right = {cut + x for x in right}
            place = next((m.start() for m in _STABLE.finditer(text, cut + 1, stop) if m.start() in known_left and m.start() in known_right), None)
            if place is not None:
                break
            wide *= 2
        total += sum(1 for x in left if begin + x < place)
        begin = place
    return total


def splits_at_spaces(path: str) -> bool:
    """Whether _STABLE is proven for a .json file: byte-level splitting as is, nothing rewritten before, no special token with white space."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = spec.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    return plain and not spec.get("normalizer") and not any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in spec.get("added_tokens", ()))


def _count(path: str, chunk: int) -> Callable[[list[str]], list[int]]:
    tool = load(path)
    if path.endswith(".model"):
        # Pieces there may cross any place, so no boundary is provably stable: whole texts.
        return lambda texts: [len(x) for x in tool.encode(texts, num_threads=1)]
    if not splits_at_spaces(path):
        return lambda texts: [len(tool.encode(t, add_special_tokens=False)) for t in texts]

    def count(texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        short, size = [], 0
        for i, t in enumerate(texts):
            if len(t) > chunk + OVERLAP:
                out[i] = spliced_count(t, lambda part: token_starts(tool, part), chunk)
                continue
            short.append(i)
            size += len(t)
            if size > BATCH_CHARS:
                for k, e in zip(short, tool.encode_batch_fast([texts[k] for k in short], add_special_tokens=False), strict=True):
                    out[k] = len(e)
                short, size = [], 0
        for k, e in zip(short, tool.encode_batch_fast([texts[k] for k in short], add_special_tokens=False), strict=True):
            out[k] = len(e)
        return out

    return count


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", ident: str = "doc_id", limit: int = 512, chunk: int = CHUNK) -> DataFrame:
    """One row for each input row: the identifier, n_bytes, n_tokens, over_limit (n_tokens > limit).

    vocabulary: path of a .json or .model file, present on every executor. Texts longer than a
    chunk are spliced where splits_at_spaces() holds, and encoded whole otherwise. Counts are those of
    the library over the whole text without added special tokens; special strings inside a text
    are handled as the library does by default. Null texts count as empty: 0 bytes, 0 tokens.
    Rows are independent, so repeated rows and null identifiers pass through. Other columns are
    not returned.
    """
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[ident]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count = _count(vocabulary, chunk)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = count(texts)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(tokens, pa.int64()), pa.array([k > limit for k in tokens], pa.bool_()),
            ], names=["id", "n_bytes", "n_tokens", "over_limit"])

    out = docs.select(docs[ident].alias("id"), docs[text].alias("text")).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", ident)
