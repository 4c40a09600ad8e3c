"""Toxicity: a convolutional text classifier trained in numpy.

Words (A-Z lower-cased, outer punctuation removed) are hashed twice, and their first 6 and 4 bytes
once each; a word's embedding is the four buckets' vectors side by side, so that two words look
alike only if all hashes collide, and forms of one stem are alike in part.
Filters of several widths slide over the words, each filter's largest response over the whole
text is kept, and a logistic layer scores the maxima. Scores are then calibrated for the
language that the text's own function words show: the threshold that separates best on a
held-back part of the training rows moves to 0.5. Every labelled row outside the held-out fold
trains or calibrates: a start is learned in one task and carried on in shards.
"""

from __future__ import annotations

import copy
import math
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, discard, drop_shuffles, find_words, hash_words, materialise, release, row_slices, utf8_column

#: Labelled rows of the start of training at most, and bytes of their word hashes; both bound what its one task holds.
START_ROWS, START_BYTES = 6000, 64 << 20
#: Labelled rows of a shard of the pass over all of them, and the rate of learning there.
SHARD_ROWS, PASS_RATE = 8192, 0.03
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 8, 12, (1, 2, 3)
#: First bytes of a word that are hashed beside the word itself (twice).
STEMS = (6, 4)
PARTS = 2 + len(STEMS)
WIDE = PARTS * DIM
EPOCHS, RATE, SEED = 6, 0.1, 17
#: Words of a text that are convolved at once; the maxima of the parts are joined.
BLOCK_WORDS = 1 << 15
#: Steps of a probability that calibration tells apart; slices of a part of the table that are averaged by themselves.
LEVELS, SLICES = 10_000, 4

#: Function words that tell languages apart.
FUNCTION_WORDS = {
    "en": "the and of to in is that for was it with this are by",
    "de": "der die und den das ist nicht ein eine mit von zu auf auch",
    "fr": "le les et des une est dans que pour qui sur pas au du",
    "es": "el los y del una es por con para las se como más al",
}
LANGUAGES = (*FUNCTION_WORDS, "other")

_EDGE = np.zeros(256, bool)
_EDGE[[ord(c) for c in ".,;:!?\"'()[]{}*-_"]] = True


@dataclass
class Model:
    table: np.ndarray  # PARTS x BUCKETS x DIM
    filters: list[np.ndarray]  # for each width: width * WIDE x FILTERS
    bias: np.ndarray
    out: np.ndarray
    base: float
    cuts: np.ndarray  # threshold of each language


@dataclass
class Sums:
    """Sums of squared gradients of a model's parts (Adagrad); of a row of the table, their mean."""

    table: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    base: float


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes of the words, first word of each row and one more): outer punctuation is removed, words of nothing else go.

    A code holds the bucket of each part, 16 bits each.
    """
    starts, ends, rows = find_words(data, offsets)
    for _ in range(3):
        if not len(starts):
            break
        starts = starts + (_EDGE[data[starts]] & (starts < ends - 1))
        ends = ends - (_EDGE[data[ends - 1]] & (ends - 1 > starts))
    keep = ~_EDGE[data[starts]] if len(starts) else np.zeros(0, bool)
    starts, ends, rows = starts[keep], ends[keep], rows[keep]
    h, low = hash_words(data, starts, ends), np.uint64(BUCKETS - 1)
    code = (h & low) | ((h >> np.uint64(40)) & low) << np.uint64(16)
    for k, stem in enumerate(STEMS):
        code |= (hash_words(data, starts, np.minimum(ends, starts + stem)) & low) << np.uint64(16 * (k + 2))
    return code, np.searchsorted(rows, np.arange(len(offsets)))


def _known_hashes() -> tuple[np.ndarray, np.ndarray]:
    hashes, codes = [], []
    for k, words in enumerate(FUNCTION_WORDS.values()):
        data = np.frombuffer(words.encode(), np.uint8)
        h, _ = words_of(data, np.array([0, len(data)]))
        hashes.append(h)
        codes += [k] * len(h)
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes)
    return hashes[order], np.array(codes)[order]


_KNOWN, _KNOWN_CODES = _known_hashes()


def language(hashes: np.ndarray) -> int:
    """Index in LANGUAGES of the language with most function words; the last if there are none."""
    at = np.minimum(np.searchsorted(_KNOWN, hashes), len(_KNOWN) - 1)
    counts = np.bincount(_KNOWN_CODES[at[_KNOWN[at] == hashes]], minlength=len(FUNCTION_WORDS))
    return int(counts.argmax()) if counts.any() else len(FUNCTION_WORDS)


def _buckets(codes: np.ndarray) -> list[np.ndarray]:
    return [(codes >> np.uint64(16 * k)).astype(np.int64) & (BUCKETS - 1) for k in range(PARTS)]


def _maxima(model: Model, hashes: np.ndarray, places: bool = False):
    """Largest response of every filter over all words, and with places where each is reached."""
    n_filters = FILTERS * len(WIDTHS)
    best, where = np.full(n_filters, -np.inf, np.float32), np.zeros(n_filters, np.int64)
    widest = max(WIDTHS)
    pad = widest - 1
    n = len(hashes)
    for a in range(0, max(1, n), BLOCK_WORDS):
        part = hashes[a : a + BLOCK_WORDS + pad]
        e = np.zeros((max(1, len(part)) + pad, WIDE), np.float32)
        for k, b in enumerate(_buckets(part)):
            e[: len(part), k * DIM : (k + 1) * DIM] = model.table[k][b]
        rows = max(1, min(len(part), BLOCK_WORDS))
        for j, width in enumerate(WIDTHS):
            w = model.filters[j].reshape(width, WIDE, FILTERS)
            r = e[:rows] @ w[0]
            for k in range(1, width):
                r += e[k : k + rows] @ w[k]
            top = r.argmax(0)
            value = r[top, np.arange(FILTERS)]
            s = slice(j * FILTERS, (j + 1) * FILTERS)
            better = value > best[s]
            best[s][better] = value[better]
            where[s][better] = top[better] + a
    best = best + model.bias
    return (best, where) if places else best


def _logit(model: Model, best: np.ndarray) -> float:
    return float(np.maximum(best, 0) @ model.out) + model.base


def _prob(x: float) -> float:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _start(seed: int = SEED) -> tuple[Model, Sums]:
    rng = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    model = Model(
        table=rng.normal(0, 0.3, (PARTS, BUCKETS, DIM)).astype(np.float32),
        filters=[rng.normal(0, 1 / np.sqrt(w * WIDE), (w * WIDE, FILTERS)).astype(np.float32) for w in WIDTHS],
        bias=np.full(n_filters, -0.5, np.float32),
        out=np.abs(rng.normal(0.3, 0.1, n_filters)).astype(np.float32),
        base=-1.0,
        cuts=np.full(len(LANGUAGES), 0.5),
    )
    model.out[n_filters // FILTERS :: 4] *= -1  # some filters speak against
    sums = Sums(np.full((PARTS, BUCKETS), 1e-3, np.float32), [np.full_like(f, 1e-3) for f in model.filters], np.full(n_filters, 1e-3, np.float32), np.full(n_filters, 1e-3, np.float32), 1e-3)
    return model, sums


def _constant(rows: int, toxic: int) -> Model:
    """The model that scores every text as the labels' mean says."""
    model, _ = _start()
    model.out[:] = 0
    model.base = float(np.log((toxic + 0.5) / (rows - toxic + 0.5))) if rows else 0.0
    return model


def _step(model: Model, sums: Sums, h: np.ndarray, label: int, weight: float, rate: float) -> None:
    """One step of Adagrad on one text."""
    best, where = _maxima(model, h, True)
    d = (_prob(_logit(model, best)) - label) * weight
    live = best > 0
    up = np.where(live, d * model.out, 0)
    g = d * np.maximum(best, 0) + 1e-4 * model.out
    sums.out += g * g
    model.out -= rate * g / np.sqrt(sums.out)
    sums.base += d * d
    model.base -= rate * d / np.sqrt(sums.base)
    if not len(h) or abs(d) < 1e-3:
        return
    sums.bias += up * up
    model.bias -= rate * up / np.sqrt(sums.bias)
    for j, width in enumerate(WIDTHS):
        s = slice(j * FILTERS, (j + 1) * FILTERS)
        act = np.flatnonzero(live[s])
        if not len(act):
            continue
        u, at = up[s][act], where[s][act]
        for k in range(width):
            p = at + k
            inside = p < len(h)
            q, uu, aa = p[inside], u[inside], act[inside]
            if not len(q):
                continue
            rows, buckets = slice(k * WIDE, (k + 1) * WIDE), _buckets(h[q])
            e = np.concatenate([model.table[m][b] for m, b in enumerate(buckets)], 1)
            back = model.filters[j][rows][:, aa].T * uu[:, None]
            g = (e * uu[:, None]).T
            sums.filters[j][rows, aa] += g * g
            model.filters[j][rows, aa] -= rate * g / np.sqrt(sums.filters[j][rows, aa])
            for m, b in enumerate(buckets):
                gb = back[:, m * DIM : (m + 1) * DIM]
                np.add.at(sums.table[m], b, (gb * gb).mean(1))
                np.add.at(model.table[m], b, -rate * gb / np.sqrt(sums.table[m][b])[:, None])


def _weight(rows: int, toxic: int) -> float:
    """How much a toxic row counts beside a clean one."""
    return float(np.sqrt((rows - toxic) / toxic))


def learn(texts: list[np.ndarray], labels: np.ndarray, seed: int = SEED) -> tuple[Model, Sums]:
    """Some epochs over texts (hashes of their words) of both labels."""
    model, sums = _start(seed)
    rng, weight = np.random.default_rng(seed), _weight(len(labels), labels.sum())
    for epoch in range(EPOCHS):
        for i in rng.permutation(len(texts)):
            _step(model, sums, texts[i], labels[i], weight if labels[i] else 1.0, RATE * (1 - epoch / EPOCHS))
    return model, sums


def train(texts: list[np.ndarray], labels: np.ndarray, tune: np.ndarray, seed: int = SEED) -> Model:
    """Fits on the texts (hashes of their words) where tune is false; calibrates where it is true.

    With no row of one of the two labels the model scores every text as the labels' mean says.
    """
    own = np.flatnonzero(~tune)
    if len(own) == 0 or labels[own].min() == labels[own].max():
        return _constant(len(labels), labels.sum())
    model, _ = learn([texts[i] for i in own], labels[own], seed)
    model.cuts = cuts(levels(model, ((texts[i], labels[i]) for i in np.flatnonzero(tune))))
    return model


def levels(model: Model, rows: Iterable[tuple[np.ndarray, int]]) -> np.ndarray:
    """Number of rows by language, probability in steps of 1 / LEVELS, and label."""
    counts = np.zeros((len(LANGUAGES), LEVELS + 1, 2), np.int64)
    for h, label in rows:
        counts[language(h), int(_prob(_logit(model, _maxima(model, h))) * LEVELS + 0.5), int(label > 0)] += 1
    return counts


def cuts(counts: np.ndarray) -> np.ndarray:
    """The threshold of each language; one with few rows, or rows of one label, takes that of all rows."""
    overall = _best_cut(counts.sum(0), 0.5)
    return np.array([_best_cut(own, overall) if own.sum() >= 50 else overall for own in counts])


def _best_cut(counts: np.ndarray, else_: float) -> float:
    """The threshold with fewest errors, the highest of equals; of the gap between levels where it may lie, the middle."""
    clean, toxic = counts.T
    if not clean.any() or not toxic.any():
        return else_
    below = lambda c: np.concatenate([[0], np.cumsum(c)])
    wrong = below(toxic) + clean.sum() - below(clean)  # from level k on counts as toxic
    k = len(wrong) - 1 - int(wrong[::-1].argmin())
    held = np.flatnonzero(clean + toxic)
    high, low = held[held >= k], held[held < k]
    return float(np.clip(((high[0] if len(high) else LEVELS) + (low[-1] if len(low) else 0)) / 2 / LEVELS, 0.02, 0.98))


def score(model: Model, hashes: np.ndarray) -> float:
    """0 to 1; 0.5 is the threshold of the text's language."""
    p, cut = float(_prob(_logit(model, _maxima(model, hashes)))), model.cuts[language(hashes)]
    return 0.5 * p / cut if p < cut else 0.5 + 0.5 * (p - cut) / (1 - cut)


def fold(ident):
    """crc32 of the identifier as text, modulo 5; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id", label: str = "toxic", rows: int = START_ROWS, most_bytes: int = START_BYTES, shard_rows: int = SHARD_ROWS) -> Model:
    """A model from all labelled rows outside the held-out fold (fold 0), whole texts.

    Folds 2 to 4 train, fold 1 calibrates. Rows with a null label are left out; labels without a
    document don't count; of several labels of an identifier the larger counts, of several texts
    the first in order.

    Training starts in one task, with some epochs over at most `rows` rows of `most_bytes` together:
    those with the smallest xxhash64 of the identifier, a quarter of them toxic ones if there are
    so many; a row that doesn't fit into what is left of the bytes is passed over there. Then every row
    trains: shards of about `shard_rows` go on from that start, each by itself, and the model takes the mean
    of their changes. Thresholds come from counts over all rows of fold 1. The identifier alone
    deals the rows out, so that the layout of the input and the cluster don't matter.
    """
    spark = bounded_batches(docs.sparkSession)
    marks = labels.select(labels[ident].alias("_tx_id"), labels[label].cast("int").alias("_tx_y")).where(F.col("_tx_y").isNotNull() & (fold(F.col("_tx_id")) != 0))
    marks = marks.groupBy("_tx_id").agg(F.max("_tx_y").alias("_tx_y"))
    both = docs.select(docs[ident].alias("_tx_id"), docs[text].alias("_tx_text")).where(fold(F.col("_tx_id")) != 0).join(marks, "_tx_id")
    both = both.groupBy("_tx_id").agg(F.min("_tx_text").alias("_tx_text"), F.max("_tx_y").alias("_tx_y"))
    hashed = both.select("_tx_id", "_tx_y", fold(F.col("_tx_id")).alias("fold"), "_tx_text").mapInArrow(_hash_batches, "id string, y int, fold int, h binary")
    hashed = materialise(hashed.withColumn("place", F.xxhash64("id")), "toxicity-rows", compression="zstd")
    drop_shuffles(spark)
    try:
        return _fit(hashed, rows, most_bytes, shard_rows)
    finally:
        discard(hashed)


def _fit(hashed: DataFrame, rows: int, most_bytes: int, shard_rows: int) -> Model:
    """As fit, from rows (id, y, fold, h, place)."""
    spark, is_toxic = hashed.sparkSession, F.col("y") > 0
    own = hashed.where("fold > 1")
    n, toxic, n_all, toxic_all = hashed.agg(F.count_if(F.col("fold") > 1), F.count_if((F.col("fold") > 1) & is_toxic), F.count(F.lit(1)), F.count_if(is_toxic)).first()
    if toxic in (0, n):
        return _constant(n_all, toxic_all)
    some = max(1, min(toxic, rows // 4), rows - (n - toxic))
    last = [own.where(which).select("place").orderBy("place").limit(max(1, k)).agg(F.max("place")).first()[0] for which, k in ((is_toxic, some), (~is_toxic, rows - some))]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, y, left = [], [], most_bytes
        for h, label in _rows(batches):
            if h.nbytes <= left:
                left -= h.nbytes
                texts.append(h)
                y.append(label)
        both = bool(y) and 0 < sum(y) < len(y)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(learn(texts, np.array(y, np.int64)) if both else _start())], pa.binary())], names=["model"])
        release()

    ordered = own.where(F.col("place") <= F.when(is_toxic, last[0]).otherwise(last[1])).repartition(1).sortWithinPartitions("place", "id").select("h", "y")  # about `rows` rows
    model, sums = pickle.loads(ordered.mapInArrow(first, "model binary").first()["model"])

    shards, weight, begin = math.ceil(n / shard_rows), _weight(n, toxic), spark.sparkContext.broadcast((model, sums))

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, old_sums = begin.value
        new, new_sums = copy.deepcopy(begin.value)
        n = 0
        for h, label in _rows(batches):
            _step(new, new_sums, h, label, weight if label else 1.0, PASS_RATE)
            n += 1
        if n:
            yield from _changes(old, old_sums, new, new_sums, n, TaskContext.get().partitionId())
        release()

    dealt = own.select("h", "y", "place", "id", F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int").alias("shard"))
    dealt = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("place", "id").select("h", "y")
    changes = dealt.mapInArrow(go_on, "slice int, shard int, n long, at binary, change binary")
    slices = changes.repartitionById(PARTS * SLICES + 1, F.col("slice")).sortWithinPartitions("slice", "shard")
    for row in slices.mapInArrow(_mean_changes, "slice int, at binary, change binary").toLocalIterator():
        change = np.frombuffer(row["change"], np.float32)
        if row["slice"] < PARTS * SLICES:
            model.table.reshape(-1, DIM)[np.frombuffer(row["at"], np.int32)] += change.reshape(-1, DIM)
        else:
            _put_dense(model, _dense(model) + change)
    begin.destroy()
    drop_shuffles(spark)

    shared = spark.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = levels(shared.value, _rows(batches))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts.ravel()[at], pa.int64())], names=["at", "n"])
        release()

    counts = np.zeros((len(LANGUAGES), LEVELS + 1, 2), np.int64)
    for row in hashed.where("fold = 1").select("h", "y").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # at most as many as counts has
        counts.ravel()[row["at"]] = row["n"]
    model.cuts = cuts(counts)
    return model


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int]]:
    """(hashes, label 0 or 1) of rows (h, y), one at a time."""
    for batch in batches:
        for h, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            yield np.frombuffer(h.as_py(), np.uint64), int(y > 0)


def _dense(model: Model) -> np.ndarray:
    return np.concatenate([*(f.ravel() for f in model.filters), model.bias, model.out, [model.base]]).astype(np.float32)


def _put_dense(model: Model, values: np.ndarray) -> None:
    *parts, base = np.split(values, np.cumsum([*(f.size for f in model.filters), len(model.bias), len(model.out)]))
    model.filters = [p.reshape(f.shape) for p, f in zip(parts, model.filters, strict=False)]
    model.bias, model.out, model.base = parts[-2], parts[-1], float(base[0])


def _changes(old: Model, old_sums: Sums, new: Model, new_sums: Sums, n: int, shard: int) -> Iterator[pa.RecordBatch]:
    """What a shard of n rows changed: the rows of the table that it touched, in slices, and all the rest."""
    touched = np.flatnonzero((new_sums.table != old_sums.table).ravel())
    change = new.table.reshape(-1, DIM)[touched] - old.table.reshape(-1, DIM)[touched]
    ends = np.searchsorted(touched, np.arange(PARTS * SLICES + 1) * (BUCKETS // SLICES))
    out = [(k, touched[a:b].astype(np.int32).tobytes(), change[a:b].tobytes()) for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if a < b]
    out.append((PARTS * SLICES, b"", (_dense(new) - _dense(old)).tobytes()))
    slices, at, values = zip(*out, strict=True)
    same = lambda x, kind: pa.array([x] * len(out), kind)
    yield pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), same(shard, pa.int32()), same(n, pa.int64()), pa.array(at, pa.binary()), pa.array(values, pa.binary())], names=["slice", "shard", "n", "at", "change"])


def _mean_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _changes, in order of slice and shard, to one of each slice: the mean over the shards that touched a row of the table, and by rows for the rest."""
    now, total, seen = None, None, None

    def out():
        at = np.flatnonzero(seen) if now < PARTS * SLICES else np.zeros(0, np.int64)
        mean = total[at] / seen[at, None] if now < PARTS * SLICES else total / seen
        first = now * (BUCKETS // SLICES)
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([(at + first).astype(np.int32).tobytes()], pa.binary()), pa.array([mean.astype(np.float32).tobytes()], pa.binary())], names=["slice", "at", "change"])

    for batch in batches:
        for k, n, at, change in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True):
            change = np.frombuffer(change.as_py(), np.float32).astype(np.float64)
            if k != now:
                if now is not None:
                    yield out()
                now, total, seen = (k, np.zeros((BUCKETS // SLICES, DIM)), np.zeros(BUCKETS // SLICES)) if k < PARTS * SLICES else (k, np.zeros(len(change)), 0)
            if k < PARTS * SLICES:
                at = np.frombuffer(at.as_py(), np.int32) - k * (BUCKETS // SLICES)
                total[at] += change.reshape(-1, DIM)
                seen[at] += 1
            else:
                total += n * change
                seen += n
    if now is not None:
        yield out()
    release()


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8_column(batch.column(3))
        out: list[bytes] = []
        for a, b in row_slices(offsets):
            h, first = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            out += [h[first[k] : first[k + 1]].tobytes() for k in range(b - a)]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), batch.column(2).cast(pa.int32()), pa.array(out, pa.binary())], names=["id", "y", "fold", "h"])


def _scores(model: Model, texts: pa.Array) -> list[float]:
    data, offsets = utf8_column(texts)
    out: list[float] = []
    for a, b in row_slices(offsets):
        h, first = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        out += [score(model, h[first[k] : first[k + 1]]) for k in range(b - a)]
    return out


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores below 0.5. Null counts as empty."""
    shared, at = bounded_batches(docs.sparkSession).sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([s < 0.5 for s in _scores(shared.value, batch.column(at))], pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)


def score_documents(docs: DataFrame, model: Model, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """One row for each input row: identifier, held_out, score, predicted (score >= 0.5).

    Whole texts are scored; null counts as empty. Repeated rows score alike. The text alone
    decides a score. Other columns are dropped.
    """
    shared = bounded_batches(docs.sparkSession).sparkContext.broadcast(model)  # of fixed size: about 8 MB
    kind = dict(docs.dtypes)[ident]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            out = _scores(m, batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64()), pa.array([int(s >= 0.5) for s in out], pa.int32())], names=["id", "held_out", "score", "predicted"])

    rows = docs.select(docs[ident].alias("id"), (fold(docs[ident]) == 0).alias("held_out"), docs[text].alias("text"))
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", ident)
