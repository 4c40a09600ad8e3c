"""Each operator on a table of odd cases, against brute force; on an empty table; and on sf0.001."""

import base64
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from tabloom import storage
from tabloom.llm import near_dedup as near_dedup_module
from tabloom.llm import queries as Q
from tabloom.llm import sharding
from tabloom.llm.bpe import bpe_roundtrip
from tabloom.llm.exact_dedup import exact_dedup
from tabloom.llm.exact_dedup import splitters as exact_dedup_splitters
from tabloom.llm.mixing import mix, mixed_documents
from tabloom.llm.mpeg_audio import mpeg_column
from tabloom.llm.near_dedup import near_dedup
from tabloom.llm.secrets import secret_spans
from tabloom.llm.sharding import shard_by_bytes
from tabloom.llm.suffix_dedup import _fetch, suffix_dedup
from tabloom.llm.token_count import token_counts
from tabloom.llm.toxicity import fit, score_documents, without_toxic

from .helpers import WORD, near_components, normal, odd_rows, passage_bytes, repeated, sha, shingles, table

RANKS, PATTERN, JSON = P.path("byte_bpe_50k.tiktoken"), P.PATTERN, P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def rows():
    return odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows).repartition(5).persist()


def test_exact_dedup(docs, rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[normal(t)].append(i)
    out = exact_dedup(docs, carry=["doc_id", "text", "source"]).collect()
    assert len(out) == len(rows)
    kept = Counter()
    for r in out:
        ids = groups[normal(r["text"])]
        known = [i for i in ids if i is not None]
        assert r["keep_id"] == (min(known) if known else None)
        assert r["group_size"] == len(ids) and r["text_sha256"] == sha(normal(r["text"]))
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
            kept[normal(r["text"])] += 1
    assert set(kept) == set(groups) and set(kept.values()) == {1}


def test_exact_dedup_splits_a_hot_text(spark):
    df = spark.createDataFrame([(k, "same  text" if k % 2 else "same text") for k in range(3000)] + [(5000, "other")], "doc_id long, text string")
    out = exact_dedup(df).collect()
    assert sum(r["kept"] for r in out) == 2 and {r["group_size"] for r in out} == {3000, 1} and {r["keep_id"] for r in out} == {0, 5000}


def test_exact_dedup_inside_long_prefixes_and_of_equal_rows(spark):
    """Texts that share 40 and 600 characters, equal rows, and copies across ranges: several splitters fall into each."""
    rows = [(k, "a" * 40 + f"{k % 700:03d}") for k in range(2000)] + [(3000 + k, "b" * 600 + f"{k % 300}  x") for k in range(900)]
    rows += [(9, "equal")] * 800 + [(None, "\x01 no id")] * 700 + [(5000, "b" * 600 + "7 x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).persist()
    assert len(exact_dedup_splitters(docs, "text", "doc_id", 16)[1]) >= 2
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    out = exact_dedup(docs, carry=["doc_id", "text"]).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(rows)
    kept = Counter(normal(r["text"]) for r in out if r["kept"])
    assert set(kept) == set(groups) and set(kept.values()) == {1}
    for r in out:
        ids = groups[normal(r["text"])]
        assert r["group_size"] == len(ids) and r["keep_id"] == min((i for i in ids if i is not None), default=None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    bare = exact_dedup(docs).collect()
    cells = lambda rows: Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in rows)
    assert cells(bare) == cells(out)


@pytest.mark.parametrize(("words", "percent"), [(5, 80), (3, 85), (1, 60)])
def test_near_dedup(docs, rows, words, percent):
    want = near_components([(i, t) for i, t, _ in rows], words, percent)
    out = near_dedup(docs, words=words, percent=percent).collect()
    assert len(out) == len(rows)
    sizes = Counter((i, len(shingles(t, words))) for i, t, _ in rows)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in out) == sizes
    for r in out:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["component_id"] == r["doc_id"])


def test_near_dedup_of_a_large_group(spark):
    """Near copies in a chain and around a centre: no pair is compared by an identifier's place, all links count."""
    words = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(400):
        own = list(words)
        for j in range(k % 6):
            own[(7 * k + 17 * j) % 120] = f"x{k}y{j}"
        rows.append((1000 - k, " ".join(own)))
    out = near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85).collect()
    want = near_components(rows, 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in out} == want


@pytest.mark.parametrize(("key", "block"), [(12, 6), (3, 2), (2048, 5)])
def test_near_dedup_by_representatives(spark, monkeypatch, key, block):
    """Families with and without a member that is near all others, chains, and families that share keys: with small blocks all links are found."""
    monkeypatch.setattr(near_dedup_module, "KEY_BLOCK", key)
    monkeypatch.setattr(near_dedup_module, "SET_BLOCK", block)
    rng = random.Random(key)
    rows = []
    for family in range(4):
        words = [f"f{family}w{k}" for k in range(100)]
        for k in range(30):
            own = list(words)
            for j in range(k // 3 if family % 2 else k % 7):  # a chain, or a cloud
                own[(j * 9 + family) % 100] = f"x{k // 3 if family % 2 else k}y{j}"
            rows.append((rng.randrange(10**6), " ".join(own)))
    rows += [(rng.randrange(10**6), " ".join(f"f0w{k}" for k in range(60)) + " " + " ".join(f"f1w{k}" for k in range(60))) for _ in range(3)]
    out = near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=60).collect()
    want = near_components(rows, 3, 60)
    assert {r["doc_id"]: r["component_id"] for r in out} == want


def test_token_counts(docs, rows):
    tool = Tokenizer.from_file(JSON)
    want = Counter((i, len((t or "").encode()), len(tool.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    out = token_counts(docs, JSON, chunk=1 << 12).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in out) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in out)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_where_no_place_is_stable(docs, rows, name):
    """Lower-casing and pieces that may cross spaces: whole texts, long ones too."""
    path = P.path(name)
    tool = sentencepiece.SentencePieceProcessor(model_file=path) if name.endswith(".model") else Tokenizer.from_file(path)
    count = (lambda t: len(tool.encode(t))) if name.endswith(".model") else (lambda t: len(tool.encode(t, add_special_tokens=False).ids))
    out = token_counts(docs, path, chunk=1 << 10).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in out) == Counter((i, count(t or "")) for i, t, _ in rows)


def test_bpe(docs, rows):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    tool = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, t, _ in rows:
        ids = tool.encode_ordinary(t or "")
        want[i, len(ids), sha(" ".join(map(str, ids))), sha(t or ""), tuple(ids)] += 1
    out = bpe_roundtrip(docs, RANKS, PATTERN, with_ids=True).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"])) for r in out) == want


def test_secrets(docs, rows):
    out = {r["doc_id"]: r for r in secret_spans(docs).collect()}
    r = out[20]
    assert (r["n_assign"], r["n_access"], r["n_hex"]) == (1, 1, 1)
    assert r["spans"].split(",")[:2] == ["assign:0:33", "access:11:33"]
    assert out[1]["spans"] == "" and out[1]["base_sha256"] == sha("")
    assert secret_spans(docs).count() == len(rows)


def test_mpeg(docs, rows):
    out = mpeg_column(docs).collect()
    assert len(out) == len(rows)
    want = Counter()
    for i, t, _ in rows:
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64) or bytes(64)
        want[i, len(raw), len(payload), sha(payload), zlib.crc32(payload[-64:])] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in out) == want


def test_mix(docs, rows):
    out = mix(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((i, len(WORD.findall(t or ""))) for i, t, _ in rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] and (r["position"] is None) == (r["taken"] == 0) for r in out)
    total, by = sum(r["size"] for r in out), defaultdict(list)
    for r in out:
        by[r["target"], r["source_size"]].append(r["taken"])
    assert abs(sum(t for t, _ in by) - 1.5 * total) < 1e-6 * total
    assert all(abs(sum(v) - t) <= 1 and t <= 2 * s for (t, s), v in by.items())
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, mix(docs).collect()), key=repr)


def test_mixed_documents(docs):
    """Passes add up row by row, also where rows share an identifier."""
    size = lambda t: len(WORD.findall(t or ""))
    want = Counter()
    for r in mix(docs).collect():
        want[r["doc_id"], r["size"]] += r["passes"]
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], size(r["text"])) for r in out.collect()) == +want


def test_mix_of_rows_with_one_identifier(spark):
    """Thousands of rows share an identifier or have none: targets are met, in words put out too."""
    rows = [(7 if k % 2 else None, f"w{k % 5} x y z" if k % 3 else "same text", "a" if k % 4 else "b") for k in range(6000)]
    rows += [(k, "some more words here", "c") for k in range(10, 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).persist()
    out = mix(docs).collect()
    total = sum(r["size"] for r in out)
    goals = {(r["source_size"], r["target"]) for r in out}
    assert len(out) == len(rows) and abs(sum(t for _, t in goals) - 1.5 * total) < 1e-6 * total
    assert abs(sum(r["taken"] for r in out) - 1.5 * total) <= 3 and all(r["taken"] <= 2 * r["size"] for r in out)
    given = Counter(r["source"] for r in docs.collect() for _ in r["text"].split())
    put = Counter(r["source"] for r in mixed_documents(docs).collect() for _ in r["text"].split())
    by_size = dict(goals)
    assert all(abs(put[s] - by_size[n]) <= 4 for s, n in given.items())


def test_shards(docs, rows):
    out = shard_by_bytes(docs.where("doc_id >= 100 OR doc_id < 10"), 4).collect()
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(4))
    sums = Counter()
    for r in out:
        sums[r["shard"]] += r["size"]
    assert max(sums.values()) - min(sums.values()) <= 100
    for out in (out, shard_by_bytes(docs).collect()):
        by_text = defaultdict(set)
        for r in out:
            by_text[r["text_crc32"], r["size"]].add(r["shard"])
        assert all(len(s) == 1 for s in by_text.values())
    assert len(out) == len(rows)


@pytest.mark.parametrize(("cell", "fan"), [(20_000, 256), (60, 256), (30, 4)])
def test_shards_keep_groups_whole(spark, monkeypatch, cell, fan):
    """Groups of 0.6, 0.4 and 2 shares (half of all bytes) stay whole; the other shards share the rest near-equally, with many cells too."""
    monkeypatch.setattr(sharding, "CELL_GROUPS", cell)
    monkeypatch.setattr(sharding, "FAN", fan)
    small = [(k, f"{k:04d} " + "x" * (k * 37 % 90)) for k in range(1500)]
    even = sum(len(t) + 1 for _, t in small) / (4 - 3.0)
    hot = [(2000 + 3000 * g, "abc"[g] * 49, int(share * even / 50)) for g, share in enumerate((0.6, 0.4, 2))]
    rows = small + [(first + k, t) for first, t, n in hot for k in range(n)]
    out = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(i for i, _ in rows)
    sums, where, slots = Counter(), defaultdict(set), defaultdict(list)
    for r in out:
        sums[r["shard"]] += r["size"]
        where[r["text_crc32"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in where.values()) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    largest = where[zlib.crc32(hot[2][1].encode())].pop()
    assert sums.pop(largest) == hot[2][2] * 50
    assert len(sums) == 3 and max(sums.values()) - min(sums.values()) <= 100


def test_suffix_dedup(docs, rows):
    want = Counter((i, *w) for (i, _, _), w in zip(rows, repeated([t for _, t, _ in rows]), strict=True))
    out = suffix_dedup(docs).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out) == want
    passages = passage_bytes([(i, t) for i, t, _ in rows])
    assert Counter((r["doc_id"], r["n_bytes"], r["n_passage_bytes"]) for r in out) == Counter((i, len((t or "").encode()), n) for (i, t, _), n in zip(rows, passages, strict=True))


def test_suffix_dedup_of_many_short_passages(spark):
    """Stretches around both lengths, within a document and across, at the ends and inside; identifiers are text with colons."""
    rng = random.Random(21)
    letters = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = [letters(n) for n in (287, 288, 300, 399, 400, 401, 900)]
    rows = [("a", "b:" + "x" * 3), ("a:b", "x" * 3)]
    for k in range(60):
        parts = [letters(rng.randint(0, 500))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), letters(rng.choice([0, 1, 50, 300]))]
        rows.append((f"d:{k % 50}", "".join(parts)))
    same = letters(900)
    rows += [("a", "b:" + same), ("a:b", same), ("two", letters(420) * 2), ("three", shared[6] + shared[6]), (None, shared[4]), ("", shared[4])]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    want, passages = repeated([t for _, t in rows]), passage_bytes(rows)
    out = suffix_dedup(docs, shard_bytes=1 << 30, memory=60_000).collect()  # all in one shard, much larger than its memory
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], r["n_passage_bytes"]) for r in out)
    assert got == Counter((i, *w, n) for (i, _), w, n in zip(rows, want, passages, strict=True))


def test_suffix_dedup_keeps_only_the_table_that_its_result_reads(docs, rows):
    before = set(storage._written)
    out = suffix_dedup(docs)
    left = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in storage._written if p not in before]
    assert left == ["suffix-starts"] and out.count() == len(rows)


def test_suffix_dedup_hands_pieces_on_in_small_batches():
    text = "".join(random.Random(2).choice("abcdefgh") for _ in range(20_000))
    wanted = [{"h": k, "g": k, "n": 1, "many": 1, "spread": False, "s": k << 20 | 3 << 10} for k in range(12_000)]
    kind = pa.list_(pa.struct([("h", pa.int64()), ("g", pa.int64()), ("n", pa.int64()), ("many", pa.int64()), ("spread", pa.bool_()), ("s", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([4, 5, 6]), pa.array([text, "", text[::-1]]), pa.array([wanted, [], wanted[:10]], kind)], names=["r", "q", "text", "wanted"])
    out = list(_fetch(iter([batch])))
    got = [tuple(x.values()) for b in out for x in b.to_pylist()]
    want = [(r, q, *w.values(), t[k : k + 403].encode()) for r, q, t, ws in ((1, 4, text, wanted), (3, 6, text[::-1], wanted[:10])) for k, w in enumerate(ws)]
    assert got == want and max(b.nbytes for b in out) < 3 << 20


def test_toxicity(spark, docs, rows):
    labels = spark.createDataFrame([(k, 1, int(k == 19)) for k in range(1, 140)] + [(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = fit(docs, labels)
    out = score_documents(docs, model).collect()
    assert len(out) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 5 == 0) for r in out)
    kept = without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in out)


def test_toxicity_passes_over_a_text_that_does_not_fit(spark):
    """A very long labelled text, first in hash order, doesn't keep the others out of the training sample."""
    ids = [r[0] for r in spark.sql("SELECT id FROM range(400) ORDER BY xxhash64(string(id))").collect() if zlib.crc32(str(r[0]).encode()) % 5]
    rows = [(i, "word " * 3000 if i == ids[0] else f"some plain {'vile ' if i % 4 == 0 else ''}text of number {i}") for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in ids], "doc_id long, toxic int")
    for most in (20_000, 25_000):  # below and above the long text's bytes
        scores = {r["doc_id"]: r["score"] for r in score_documents(docs, fit(docs, labels, most_bytes=most)).collect()}
        toxic, clean = ([s for i, s in scores.items() if i != ids[0] and (i % 4 == 0) == t] for t in (True, False))
        assert min(toxic) > max(clean)


def test_toxicity_learns_from_every_labelled_row(spark):
    """Words that only rows outside the start use are learned too, and thresholds count every row of fold 1."""
    rng = random.Random(3)
    late = set(range(3000))  # rows that a start of 300 doesn't hold, whether identifiers are hashed as text or not
    for key in ("id", "string(id)"):
        late -= {r[0] for r in spark.sql(f"SELECT id FROM range(3000) ORDER BY xxhash64({key}) LIMIT 700").collect()}
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]

    def words(i):
        own = [rng.choice(vocabulary) for _ in range(20)]
        if i % 3 == 0:
            own[rng.randrange(20)] = ("rotten" if i % 2 else "nasty") if i in late else "vile"
        return " ".join(own)

    docs = spark.createDataFrame([(i, words(i)) for i in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(3000)], "doc_id long, toxic int")
    out = score_documents(docs, fit(docs, labels, rows=300)).where("held_out").collect()
    wrong = sum(r["predicted"] != (r["doc_id"] % 3 == 0) for r in out)
    assert len(out) > 500 and wrong <= 0.03 * len(out), f"{wrong} of {len(out)}"


EMPTY = {
    "exact": lambda d: exact_dedup(d), "near": lambda d: near_dedup(d), "tokens": lambda d: token_counts(d, JSON), "secrets": lambda d: secret_spans(d),
    "mix": lambda d: mix(d), "mixed": lambda d: mixed_documents(d), "mpeg": lambda d: mpeg_column(d), "shards": lambda d: shard_by_bytes(d),
    "suffix": lambda d: suffix_dedup(d), "bpe": lambda d: bpe_roundtrip(d, RANKS, PATTERN),
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty(docs, name):
    assert EMPTY[name](docs.limit(0)).collect() == []


@pytest.mark.parametrize("name", EMPTY)
def test_all_null(docs, name):
    nulls = docs.where("doc_id IS NULL AND text IS NULL")
    assert EMPTY[name](nulls).count() == (0 if name == "mixed" else 1)


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert score_documents(docs, fit(docs, none)).count() == docs.count()
    assert score_documents(docs.limit(0), fit(docs.limit(0), none)).count() == 0


def test_queries_have_rows(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op4_secret_spans", "op6_mpeg_audio", "op7_shard_bytes"):
        assert Q.QUERIES[name](spark, sf_dir).count() == n
