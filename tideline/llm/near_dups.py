"""Near-duplicate texts: consistent weighted samples of TF-IDF shingles, banded, verified."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import fetch_texts, slices, text_key, utf8_texts
from tideline.llm.graph import components
from tideline.llm.shingles import FACTOR, Shingles, cached_hashes
from tideline.operators.groups import stored, storing

# Bits of a shingle's id within these tables; the bits above number the texts of a batch.
ID_BITS = 44
TABLE_BITS = 16
SEED = 42
# Bytes of the texts whose shingles are sent and weighed together; different shingles that a task counts at once, about.
CHUNK_BYTES, PART_SHINGLES, MIN_PART_BITS = 8_000_000, 2_000_000, 3
# Open buckets of so many texts are compared pair by pair; larger ones by shingles that their texts share.
FULL = 8
# So many shingles in front of a shared one are looked at for one that is shared too.
BEFORE = 6


@dataclass(frozen=True)
class NearDups:
    """Similarity from which texts are near duplicates, and shape of the bands.

    With 10 bands of 3 samples two texts of similarity 0.8 meet in a band with a chance of 99.9 %.
    """

    similarity: float = 0.8
    bands: int = 10
    rows: int = 3


class Samples:
    """Parameters of improved consistent weighted sampling: r and c from Gamma(2, 1), b from [0, 1).

    A shingle picks its triple for hash i from a table of 2^16 by a multiplicative hash.
    """

    def __init__(self, hashes: int):
        random = np.random.default_rng(SEED)
        size = 1 << TABLE_BITS
        self.r = random.gamma(2.0, 1.0, size).astype(np.float32)
        self.log_c = np.log(random.gamma(2.0, 1.0, size)).astype(np.float32)
        self.b = random.random(size).astype(np.float32)
        self.factors = random.integers(1, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def weighted(shingles: Shingles, common_ids: np.ndarray, common_idf: np.ndarray, rare_idf: float):
    """Different shingles of each text, sorted: owner, id, weight (occurrences times idf)."""
    if not len(shingles.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    both = (shingles.owner.astype(np.uint64) << np.uint64(ID_BITS)) | (shingles.hash >> np.uint64(64 - ID_BITS))
    both.sort()
    begins = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    times = np.diff(np.append(begins, len(both)))
    both = both[begins]
    ids = both & np.uint64((1 << ID_BITS) - 1)
    idf = np.full(len(ids), rare_idf)
    if len(common_ids):
        at = np.minimum(np.searchsorted(common_ids, ids), len(common_ids) - 1)
        idf = np.where(common_ids[at] == ids, common_idf[at], rare_idf)
    return (both >> np.uint64(ID_BITS)).astype(np.int64), ids, times * idf


def signatures(owner: np.ndarray, ids: np.ndarray, weights: np.ndarray, texts: int, samples: Samples, shape: NearDups):
    """Bucket of every band of each text, and which texts have any shingle."""
    present, begins = np.unique(owner, return_index=True)
    buckets = np.zeros((shape.bands, len(present)), dtype=np.uint64)
    if not len(present):
        return buckets, present
    sizes = np.diff(np.append(begins, len(owner)))
    local = np.repeat(np.arange(len(present)), sizes)
    log_w = np.log(weights).astype(np.float32)
    for i in range(shape.bands * shape.rows):
        pick = ((ids * samples.factors[i]) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)
        r, b = samples.r[pick], samples.b[pick]
        t = np.floor(log_w / r + b)
        log_a = samples.log_c[pick] - r * (t - b + 1)
        least = np.minimum.reduceat(log_a, begins)
        at = np.flatnonzero(log_a == least[local])
        at = at[np.concatenate([[True], local[at][1:] != local[at][:-1]])]
        sample = (ids[at] ^ (t[at].astype(np.int64).view(np.uint64) << np.uint64(ID_BITS))) * FACTOR
        band = buckets[i // shape.rows]
        band[:] = (band ^ (band >> np.uint64(29))) * FACTOR + (sample ^ (sample >> np.uint64(31)))
    return buckets, present


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, all first bytes first; told apart by the byte in front."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, : raw[0]] = planes.T
    return wide.view("<u8").ravel()


@dataclass(frozen=True)
class Weights:
    """Different texts in chunks (tid, _ll_key, _ll_check, n, chunk, text), and in how many rows their shingles are.

    ``counts`` (chunk, part, rows): the rows of each different shingle of the chunk in the order of its
    id, parts being ranges of ids. ``total``: all rows.
    """

    texts: DataFrame
    counts: DataFrame
    total: int


def bags(column: pa.Array, known) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text, sorted: owner, id, occurrences."""
    return weighted(Shingles(utf8_texts(column), known), np.zeros(0, np.uint64), np.zeros(0), 1.0)


def chunked(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows with the chunk of about ``limit`` bytes of text that they are in."""
    chunk, size = None, 0
    for batch in batches:
        chunks = []
        for tid, n in zip(batch.column("tid").to_pylist(), pc.binary_length(batch.column("text")).to_pylist()):
            if chunk is None or size and size + n > limit:
                chunk, size = tid, 0
            size += n
            chunks.append(chunk)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunks, pa.int64())], [*batch.schema.names, "chunk"])


def chunk_shingles(texts: DataFrame, parts: int) -> DataFrame:
    """part, chunk, ids, rows: different shingles of a chunk, by ranges of ids, and its rows that have them.

    A range has a row for each task that reads some of the chunk.
    """
    begins_at = np.arange(parts, dtype=np.uint64) << np.uint64(ID_BITS - (parts - 1).bit_length())
    names = ["part", "chunk", "ids", "rows"]

    def told(chunk: int, found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        ids, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
        rows = np.bincount(at, np.concatenate([f[1] for f in found]), minlength=len(ids)).astype(np.uint64)
        cuts = [0, *np.searchsorted(ids, begins_at[1:]).tolist(), len(ids)]
        some = [(p, i, j) for p, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]
        blobs = [packed(np.diff(ids[i:j], prepend=begins_at[p])) for p, i, j in some]
        columns = [pa.array([p for p, _, _ in some], pa.int32()), pa.array([chunk] * len(some), pa.int64())]
        columns += [pa.array(blobs, pa.binary()), pa.array([packed(rows[i:j]) for _, i, j in some], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]):
        known, chunk, found = cached_hashes(), None, []
        for whole in slices(batches, "text"):
            chunks = whole.column("chunk").to_numpy()
            begins = np.flatnonzero(np.concatenate([[True], chunks[1:] != chunks[:-1]])).tolist()
            for i, j in zip(begins, [*begins[1:], len(chunks)]):
                if found and chunk != int(chunks[i]):
                    yield from told(chunk, found)
                    found = []
                chunk = int(chunks[i])
                owner, ids, _ = bags(whole.column("text").slice(i, j - i), known)
                found.append((ids, whole.column("n").to_numpy()[i:j][owner]))
        if found:
            yield from told(chunk, found)

    return texts.select("chunk", "n", "text").mapInArrow(run, "part int, chunk long, ids binary, rows binary")


def counted(part: pa.Table) -> pa.Table:
    """chunk, part and rows: in how many rows of all chunks the shingles of a part are, in the order of their ids."""
    chunks = part.column("chunk").to_numpy()
    ids = [np.cumsum(unpacked(raw)) for raw in part.column("ids").to_pylist()]
    rows = np.concatenate([unpacked(raw) for raw in part.column("rows").to_pylist()])
    values, at = np.unique(np.concatenate(ids), return_inverse=True)
    sums = np.bincount(at, rows, minlength=len(values)).astype(np.uint64)
    pieces: dict[int, list[np.ndarray]] = {}
    bounds = np.cumsum([0, *map(len, ids)])
    for k, chunk in enumerate(chunks.tolist()):
        pieces.setdefault(chunk, []).append(at[bounds[k] : bounds[k + 1]])
    blobs = [packed(sums[several[0] if len(several) == 1 else np.unique(np.concatenate(several))]) for several in pieces.values()]
    columns = [pa.array(list(pieces), pa.int64()), pa.array([part.column("part")[0].as_py()] * len(pieces), pa.int32())]
    return pa.Table.from_arrays([*columns, pa.array(blobs, pa.binary())], ["chunk", "part", "rows"])


def weights_table(docs: DataFrame, text: str, shape: NearDups) -> Weights:
    """Exact numbers of rows that have each shingle of each different text; stored.

    Each chunk sends its different shingles once, as sorted differences, and gets back what they add up to
    over all chunks; so neither a task nor the driver holds the shingles of all texts.
    """
    rows = docs.select(*text_key(text), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = rows.groupBy("_ll_key", "_ll_check").agg(F.count(F.lit(1)).alias("n"), F.max("text").alias("text"))
    texts = texts.select(F.monotonically_increasing_id().alias("tid"), "_ll_key", "_ll_check", "n", "text")
    texts = stored(texts.mapInArrow(partial(chunked, limit=CHUNK_BYTES), "tid long, _ll_key long, _ll_check int, n long, text string, chunk long"))
    all_of = texts.agg(F.sum("n").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    # A word has some six bytes, and a shingle.
    parts = 1 << max(MIN_PART_BITS, ((all_of["bytes"] or 0) // (6 * PART_SHINGLES)).bit_length())
    counts = chunk_shingles(texts, parts).groupBy("part").applyInArrow(counted, "chunk long, part int, rows binary")
    return Weights(texts, stored(counts), all_of["rows"] or 0)


def distinct_texts(docs: DataFrame, text: str, order: str, table: Weights, shape: NearDups) -> DataFrame:
    """tid, _ll_key, _ll_check, first, n, buckets and df of every different text, stored.

    buckets are NULL without words; df: the rows that have each different shingle, in the order of ids.
    """
    firsts = docs.select(F.col(order).alias("first"), *text_key(text)).groupBy("_ll_key", "_ll_check").agg(F.min("first").alias("first"))
    names = ["tid", "_ll_key", "_ll_check", "n", "buckets", "df"]
    total = table.total

    def sign(chunk: pa.Table, counts: pa.Table) -> pa.Table:
        known, samples = cached_hashes(), Samples(shape.bands * shape.rows)
        pieces = sorted(zip(counts.column("part").to_pylist(), counts.column("rows").to_pylist()))
        df = np.concatenate([np.zeros(0, np.uint64), *[unpacked(raw) for _, raw in pieces]])
        batches = list(slices(chunk.combine_chunks().to_batches(), "text"))
        found = [bags(batch.column("text"), known) for batch in batches]
        ids = np.sort(np.concatenate([np.zeros(0, np.uint64), *[f[1] for f in found]]))
        ids = ids[np.flatnonzero(np.diff(ids, prepend=ids[:1] + np.uint64(1)))]
        if len(ids) != len(df):
            raise ValueError(f"{len(df)} counts for {len(ids)} shingles")
        made = []
        for batch, (owner, own, times) in zip(batches, found):
            rows = df[np.searchsorted(ids, own)]
            buckets, present = signatures(owner, own, times * np.log1p(total / rows), batch.num_rows, samples, shape)
            lists: list = [None] * batch.num_rows
            for k, values in zip(present, buckets.T.view(np.int64).tolist()):
                lists[k] = values
            bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            blobs = [packed(rows[i:j]) for i, j in zip(bounds, bounds[1:])]
            arrays = [*[batch.column(c) for c in names[:4]], pa.array(lists, pa.list_(pa.int64())), pa.array(blobs, pa.binary())]
            made.append(pa.RecordBatch.from_arrays(arrays, names))
        return pa.Table.from_batches(made)

    kinds = "tid long, _ll_key long, _ll_check int, n long, buckets array<long>, df binary"
    signed = table.texts.groupBy("chunk").cogroup(table.counts.groupBy("chunk")).applyInArrow(sign, kinds)
    return stored(signed.join(firsts, ["_ll_key", "_ll_check"]))


def weighed(texts: pa.Array, df: pa.Array, total: int, known) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text, sorted: owner, id, weight; ``df`` as ``distinct_texts`` tells it."""
    owner, ids, times = bags(texts, known)
    rows = np.concatenate([np.zeros(0, np.uint64), *[unpacked(raw) for raw in df.to_pylist()]])
    return owner, ids, times * np.log1p(total / rows)


def verify(pairs: DataFrame, fetched: DataFrame, table: Weights, shape: NearDups) -> DataFrame:
    """``pairs`` (a, b) with their weighted Jaccard similarity, and whether it reaches the threshold; stored.

    ``fetched`` holds their texts (tid, text, df).
    """
    total = table.total

    def compare(batches: Iterator[pa.RecordBatch]):
        known = cached_hashes()
        for batch in slices(batches, "text_a"):
            n = batch.num_rows
            sides = []
            for side in ("a", "b"):
                unique, first, at = np.unique(batch.column(side).to_numpy(), return_index=True, return_inverse=True)
                found = weighed(batch.column(f"text_{side}").take(pa.array(first)), batch.column(f"df_{side}").take(pa.array(first)), total, known)
                bounds = np.searchsorted(found[0], np.arange(len(unique) + 1))
                sides.append((at, found[1], found[2], bounds))
            similarity, similar = [], []
            for i in range(n):
                (ia, ids_a, w_a, at_a), (ib, ids_b, w_b, at_b) = sides
                a, b = slice(at_a[ia[i]], at_a[ia[i] + 1]), slice(at_b[ib[i]], at_b[ib[i] + 1])
                _, x, y = np.intersect1d(ids_a[a], ids_b[b], assume_unique=True, return_indices=True)
                both = np.minimum(w_a[a][x], w_b[b][y]).sum()
                every = w_a[a].sum() + w_b[b].sum() - both
                similarity.append(float(both / every))
                similar.append(bool(both >= shape.similarity * every - 1e-9))
            arrays = [batch.column("a"), batch.column("b"), pa.array(similarity, pa.float64()), pa.array(similar, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "similarity", "similar"])

    left, right = [fetched.select(F.col("tid").alias(x), F.col("text").alias(f"text_{x}"), F.col("df").alias(f"df_{x}")) for x in "ab"]
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b", "df_a", "df_b")
    return stored(full.mapInArrow(compare, "a long, b long, similarity double, similar boolean"))


def heaviest(members: DataFrame) -> DataFrame:
    """bucket and tid2 of the member of most weight of each bucket; stored.

    Tasks drop all others before the shuffle, so a large bucket costs no more than a small one.
    """
    order = Window.partitionBy("bucket").orderBy(F.col("weight").desc(), "tid")
    ranked = members.withColumn("rank", F.row_number().over(order)).filter("rank = 1")
    return stored(ranked.select("bucket", F.col("tid").alias("tid2")))


def first_shingles(fetched: DataFrame, tids: DataFrame, table: Weights, shape: NearDups) -> DataFrame:
    """tid, total, id, after and before: shingles of which two similar texts have one in common; stored.

    Shingles are put in one order, those in fewest of these texts first. What two similar texts
    share weighs at least ``similarity`` of either, so the first shingle they share has that much
    of the weight at or after it, in both. ``total`` is the text's weight, ``after`` what of it
    lies at or after the shingle, ``before`` the few shingles in front of it.
    """

    rows_in_all = table.total

    def told(batches: Iterator[pa.RecordBatch]):
        known = cached_hashes()
        for batch in slices(batches, "text"):
            owner, ids, weights = weighed(batch.column("text"), batch.column("df"), rows_in_all, known)
            total = np.bincount(owner, weights, minlength=batch.num_rows)[owner]
            tid = batch.column("tid").to_numpy()[owner]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tid), pa.array(ids.astype(np.int64)), pa.array(weights), pa.array(total)], ["tid", "id", "w", "total"]
            )

    rows = fetched.join(tids, "tid", "left_semi").select("tid", "text", "df")
    rows = stored(rows.mapInArrow(told, "tid long, id long, w double, total double"))
    times = rows.groupBy("id").agg(F.count(F.lit(1)).alias("times"))
    upto = Window.partitionBy("tid").orderBy("times", "id")
    placed = rows.join(times, "id").withColumn("after", F.col("total") - F.sum("w").over(upto) + F.col("w"))
    first = placed.filter((F.col("times") > 1) & (F.col("after") >= F.col("total") * shape.similarity - lost(F.col("total"))))
    before = F.collect_list("id").over(Window.partitionBy("tid").orderBy("times", "id").rowsBetween(-BEFORE, -1))
    return stored(first.select("tid", "total", "id", "after", before.alias("before")))


def lost(total: Column) -> Column:
    """What rounding may take from a sum of weights."""
    return total * 1e-9 + 1e-6


def met(left: DataFrame, right: DataFrame, on: list[str], bound: Column, shape: NearDups) -> DataFrame:
    """Pairs a, b of rows that agree in ``on``, one of them open, of different classes, that the center leaves possible."""
    others = right.select(*on, *[F.col(c).alias(f"{c}2") for c in right.columns if c not in on])
    both = (F.col("unlike") | F.col("unlike2")) & (F.col("tid") != F.col("tid2")) & (F.col("label") != F.col("label2"))
    both = both & (F.abs(F.col("similarity") - F.col("similarity2")) <= 1 - shape.similarity + 1e-6) & bound
    return left.join(others, on).filter(both).select(F.least("tid", "tid2").alias("a"), F.greatest("tid", "tid2").alias("b"))


def shared_pairs(many: DataFrame, fetched: DataFrame, table: Weights, shape: NearDups) -> DataFrame:
    """Pairs a, b of large buckets that share a shingle with enough weight at or after it; few of them twice."""
    texts = stored(many.groupBy("tid").agg(F.sort_array(F.collect_list("bucket")).alias("buckets")))
    marked = many.join(first_shingles(fetched, texts.select("tid"), table, shape).join(texts, "tid"), "tid")
    # Similar texts share this much of the sum of their weights, all of it at or after the first
    # shingle they share; in the lighter text that is twice as much of its own weight.
    share = shape.similarity / (1 + shape.similarity)
    leading = marked.filter(F.col("after") >= 2 * share * F.col("total") - lost(F.col("total")))
    lighter = (F.col("total") < F.col("total2")) | ((F.col("total") == F.col("total2")) & (F.col("tid") < F.col("tid2")))
    sums = F.col("total") + F.col("total2")
    rest = F.least("after", "after2") >= share * sums - lost(sums)
    # Of the buckets and shingles that two texts share the first makes the pair: an earlier one
    # has as much weight after it, and what a bucket rules out holds for the pair.
    once = (F.col("bucket") == F.array_min(F.array_intersect("buckets", "buckets2"))) & ~F.arrays_overlap("before", "before2")
    return met(leading, marked, ["bucket", "id"], lighter & rest & once, shape)


def open_pairs(around: DataFrame, fetched: DataFrame, table: Weights, shape: NearDups) -> DataFrame:
    """Pairs a, b of a bucket that could be similar, though neither center nor class joins them; stored.

    ``around`` (bucket, tid, similarity and similar to the center, label and center_label: classes so far).
    Left out are pairs of one class, and those that are bounded below the threshold: by the
    center (1 - similarity is a metric), or as they share no shingle that has enough of both weights after it.
    """
    slack = 1 - shape.similarity + 1e-6
    unlike = ~F.col("similar") & (F.col("label") != F.col("center_label"))
    around = stored(around.withColumn("unlike", unlike).drop("similar", "center_label"))
    nearest = around.filter("unlike").groupBy("bucket").agg(F.max("similarity").alias("nearest"))
    near = around.join(nearest, "bucket").filter(F.col("similarity") <= F.col("nearest") + slack).drop("nearest")
    near = stored(near)
    sizes = near.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    near = stored(near.join(sizes, "bucket"))
    few, many = near.filter(F.col("n") <= FULL).drop("n"), near.filter(F.col("n") > FULL).drop("n")
    # A pair of two open texts is made once.
    pairs = met(few.filter("unlike"), few, ["bucket"], (F.col("tid") < F.col("tid2")) | ~F.col("unlike2"), shape)
    if not many.isEmpty():
        pairs = pairs.unionAll(shared_pairs(many, fetched, table, shape))
    return stored(pairs.distinct())


def links(texts: DataFrame, fetch, table: Weights, shape: NearDups) -> DataFrame:
    """Pairs u, v of different texts that are near duplicates, enough of them to join every class.

    In each bucket all texts are compared with its center, the text that shares most buckets
    with others, as the original of a group of copies does. Texts unlike the center that no
    other link brings into its class are then compared with all others of the bucket that they
    could be similar to. So any two similar texts of a bucket end up in one class.
    """
    named = F.posexplode("buckets").alias("band", "value")
    all_members = texts.select("tid", named).select(F.xxhash64("band", "value").alias("bucket"), "tid")
    sizes = stored(all_members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    met = stored(
        all_members.join(sizes, "bucket").groupBy("tid").agg(F.sum("n").alias("weight"), F.collect_list("bucket").alias("all"))
    )
    fetched = fetch(met.select("tid"))
    members = met.select(F.explode("all").alias("bucket"), "tid", "weight")
    ends = {"a": F.least("tid", "tid2"), "b": F.greatest("tid", "tid2")}
    centered = stored(members.join(heaviest(members), "bucket").filter("tid <> tid2").withColumns(ends).drop("weight"))
    verified = verify(stored(centered.select("a", "b").distinct()), fetched, table, shape)
    found = stored(verified.filter("similar").select(F.col("a").alias("u"), F.col("b").alias("v")))
    if verified.filter("NOT similar").isEmpty():
        return found
    class_of = stored(components(found))
    around = (
        centered.join(verified, ["a", "b"])
        .join(class_of.select(F.col("node").alias("tid"), F.col("component").alias("label")), "tid", "left")
        .join(class_of.select(F.col("node").alias("tid2"), F.col("component").alias("center_label")), "tid2", "left")
        .select(
            "bucket", "tid", "similarity", "similar", F.coalesce("label", "tid").alias("label"),
            F.coalesce("center_label", "tid2").alias("center_label"),
        )
    )
    pairs = open_pairs(around, fetched, table, shape)
    more = verify(stored(pairs.join(verified, ["a", "b"], "left_anti")), fetched, table, shape)
    return stored(found.unionAll(more.filter("similar").select("a", "b")))


def text_classes(docs: DataFrame, text: str, order: str, shape: NearDups) -> DataFrame:
    """_ll_key, _ll_check, _ll_component, class_id, class_rows, n_links of every different text; stored."""
    with storing() as scope:
        table = weights_table(docs, text, shape)
        texts = distinct_texts(docs, text, order, table, shape)

        def fetch(tids: DataFrame) -> DataFrame:
            needed = stored(texts.select("tid", "_ll_key", "_ll_check").join(tids, "tid"))
            return stored(fetch_texts(table.texts, "text", needed).join(texts.select("tid", "df"), "tid"))

        with storing() as inner:
            edges = inner.keep(links(texts, fetch, table, shape))
        ends = edges.select(F.col("u").alias("tid")).unionAll(edges.select(F.col("v").alias("tid")))
        degree = ends.groupBy("tid").agg(F.count(F.lit(1)).alias("n_links"))
        class_of = stored(components(edges).withColumnRenamed("node", "tid").join(degree, "tid"))
        placed = texts.drop("buckets", "df").join(class_of, "tid", "left").withColumn("component", F.coalesce("component", "tid"))
        named = stored(placed.groupBy("component").agg(F.min("first").alias("class_id"), F.sum("n").alias("class_rows")))
        classes = placed.join(named, "component").select(
            "_ll_key", "_ll_check", F.col("component").alias("_ll_component"), "class_id", "class_rows",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
        return scope.keep(stored(classes))


def near_duplicates(
    docs: DataFrame, text: str = "text", order: str = "doc_id", shape: NearDups = NearDups()
) -> DataFrame:
    """``docs`` with class_id, class_rows and n_links.

    Rows are of one class if their texts are equal or joined by links between different texts
    whose weighted Jaccard similarity over five-word TF-IDF shingles is 0.8 or more. class_id is
    the smallest ``order`` value of the class, class_rows its rows, n_links the verified links of
    the row's text. NULL texts count as empty; all empty texts are equal, so they are one class;
    those of fewer than five words are one shingle. Equal rows get equal answers; rows with NULL
    in ``order`` take part (a class of such rows only has NULL as class_id). Columns named like
    an added one are replaced; an empty table gives an empty one.
    """
    added = ["class_id", "class_rows", "n_links"]
    classes = text_classes(docs, text, order, shape)
    key, check = text_key(text)
    rows = docs.drop(*added).withColumns({"_ll_key": key, "_ll_check": check})
    classes = classes.drop("_ll_component")
    return rows.join(classes, ["_ll_key", "_ll_check"]).select(*[c for c in docs.columns if c not in added], *added)


def drop_near_duplicates(
    docs: DataFrame, text: str = "text", order: str = "doc_id", shape: NearDups = NearDups()
) -> DataFrame:
    """One row of every class, with the columns of ``docs``: the first by ``order``, NULL last.

    Of rows that tie, the one stored first stays.
    """
    rows = stored(docs.withColumn("_ll_row", F.monotonically_increasing_id()))
    classes = text_classes(rows, text, order, shape)
    key, check = text_key(text)
    several = rows.select(F.col(order).alias("first"), "_ll_row", key, check).join(
        classes.filter("class_rows > 1"), ["_ll_key", "_ll_check"]
    )
    place = F.struct(F.col("first").isNull().alias("last"), "first", "_ll_row")
    best = stored(several.groupBy("_ll_component").agg(F.min(place)["_ll_row"].alias("_ll_best")))
    gone = stored(several.join(best, "_ll_component").filter("_ll_row <> _ll_best").select("_ll_row"))
    return rows.join(gone, "_ll_row", "left_anti").select(*docs.columns)
