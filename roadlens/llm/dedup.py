"""Near-duplicate documents by fast similarity sketching (operator 9).

A document is the set of its word shingles.  The sketch has ``SKETCH``
coordinates: in round ``r`` every shingle is hashed into one bin with a value
that starts with ``r``; rounds go on until every bin is filled, and after
``SKETCH`` rounds one round per bin fills whatever is left, so every
coordinate is filled for every non-empty set.  Coordinates are cut into bands;
documents that share a band are candidates, and every link is confirmed on
the full sets.

Large groups are never expanded into all pairs.  Documents with equal sets
become one class.  Classes that share a band are first compared with one
partner of the band (a different one in every band and round); classes found
linked form components, and in these rounds one bit of each coordinate keeps
pairs from the exact check whose estimate is five standard deviations too low.

Bands that still hold several components then go through the last stage whole.
Classes that are tied by such bands form a cluster; its classes are dealt to
blocks, every two blocks meet in one task with their texts, and all pairs are
counted there on their full sets, so rows grow with classes times blocks and
never with pairs.  Only links between different components leave a task.  So
every candidate pair is confirmed, refuted, or already connected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from roadlens.llm.common import drop_written, map_batches, process_cache, written
from roadlens.llm.components import components
from roadlens.plans import bounded_broadcast

#: Coordinates of a sketch (one bit of each is kept), bands and coordinates of
#: a band: at similarity 0.8 a pair shares no band with probability
#: (1 - 0.8**5)**36, about 6e-7.
SKETCH, BANDS, BAND_ROWS = 1536, 36, 5
#: Standard deviations by which an estimate may fall below the similarity.
MARGIN = 5.0
#: Rounds of one partner per band before all remaining pairs are compared.
PARTNER_ROUNDS = 3
#: Classes and shingles of a block of the last stage (a class alone may have more); a cluster of more blocks is
#: taken band by band.
BLOCK, BLOCK_SHINGLES, MAX_BLOCKS = 1024, 1 << 20, 32
#: Documents of a block pair from which on a shingle is counted by a matrix product, and its columns at a time.
COMMON, COLUMNS = 16, 2048
_U = np.uint64
_NONE = _U(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A strong bijective mixing of 64-bit integers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_table() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    blank = np.zeros(256, np.bool_)
    blank[[9, 10, 11, 12, 13, 32]] = True
    return lower, blank


#: Bytes of a text that are hashed at a time.
CHUNK = 1 << 22


def _word_hashes(raw: np.ndarray, gap: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The 64-bit hash of every word of ``raw`` bytes (``gap``: blank bytes)."""
    edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64)
    lens = ends - starts
    at = np.concatenate(([0], np.cumsum(lens)[:-1]))
    place = np.arange(int(lens.sum())) - np.repeat(at, lens)
    # every letter is mixed with its place, so words that a polynomial would confuse stay apart
    values = mix(lower[raw[~gap]].astype(np.uint64) + (place.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15))
    return mix(np.add.reduceat(values, at) + lens.astype(np.uint64))


def shingles(text: str, words: int) -> np.ndarray:
    """The distinct 64-bit hashes of the word shingles of a text (A-Z in
    lower case); with fewer words than ``words`` all of them are one shingle;
    empty without a word."""
    lower, blank = process_cache("bytes", _byte_table)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    found, at = [], 0
    while at < len(raw):
        to = min(at + CHUNK, len(raw))
        gap = blank[raw[at:to]]
        if to < len(raw):  # cut at the last blank, or after the word where there is none
            last = np.flatnonzero(gap)
            if len(last):
                to = at + int(last[-1]) + 1
                gap = gap[:to - at]
            else:
                rest = np.flatnonzero(blank[raw[to:]])
                to = to + int(rest[0]) if len(rest) else len(raw)
                gap = blank[raw[at:to]]
        found.append(_word_hashes(raw[at:to], gap, lower))
        at = to
    w = np.concatenate(found) if found else np.empty(0, np.uint64)
    n = min(words, len(w))
    if not n:
        return w
    h = w[: len(w) - n + 1]
    for i in range(1, n):
        h = mix(h * _U(0xD6E8FEB86659FD93) + w[i: len(w) - n + 1 + i])
    return np.unique(h)


def _thrown(x: np.ndarray, rounds: np.ndarray) -> np.ndarray:
    """The hash of every element in every round, (round, element)."""
    return mix(x[None, :] + (_U(0x9E3779B97F4A7C15) * (rounds + _U(1)))[:, None])


def sketch(x: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """Fast similarity sketch of a non-empty set of 64-bit hashes.  Rounds of
    a small set are thrown several at a time: a bin keeps its first round's
    value, so the rounds thrown beyond the last needed one change nothing."""
    out = np.full(size, _NONE)
    step = max(1, 4 * size // len(x))
    with np.errstate(over="ignore"):
        for at in range(0, size, step):
            r = np.arange(at, min(at + step, size), dtype=np.uint64)
            h = _thrown(x, r)
            value = (h & _U(0xFFFFFFFFFF)) | (r << _U(40))[:, None]
            np.minimum.at(out, ((h >> _U(40)) % _U(size)).astype(np.int64).ravel(), value.ravel())
            if out.max() != _NONE:
                return out
        empty = np.flatnonzero(out == _NONE)
        for at in range(0, len(empty), step):
            bins = empty[at:at + step]
            r = (bins + size).astype(np.uint64)
            out[bins] = ((_thrown(x, r) & _U(0xFFFFFFFFFF)) | (r << _U(40))[:, None]).min(axis=1)
    return out


def band_keys(sk: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    b = sk[: bands * rows].reshape(bands, rows)
    h = mix(np.arange(bands, dtype=np.uint64) + _U(0x51ED27))
    for i in range(rows):
        h = mix(h * _U(0xD6E8FEB86659FD93) + b[:, i])
    return h.view(np.int64)


def bits_of(sk: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, packed into 64-bit integers."""
    return np.packbits((mix(sk) & _U(1)).astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, n_shingles, fp, bands, bits)`` of ``(doc_id, text)``: set
    size, a 128-bit fingerprint of the set, the band keys and the sketch's
    bits (null when empty)."""
    def run(batch: pa.RecordBatch):
        n, fp, bands, bits = [], [], [], []
        with np.errstate(over="ignore"):
            for t in batch.column(1).to_pylist():
                x = shingles(t or "", words)
                sk = sketch(x) if len(x) else None
                n.append(len(x))
                fp.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                bands.append(None if sk is None else band_keys(sk))
                bits.append(None if sk is None else bits_of(sk))
        return batch.column(0), n, fp, bands, bits

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, run, f"doc_id {kind}, n_shingles bigint, fp binary, bands array<bigint>, bits array<bigint>")


def shingle_set(text: str, words: int) -> frozenset:
    """The set of shingles themselves (not hashes), for exact comparison."""
    low = text.encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
    w = low.split()                                      # bytes: the six ASCII blanks only
    if len(w) < words:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*(w[i:] for i in range(words))))


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``(a, b)`` of the ``pairs`` whose full sets reach the similarity."""
    both = (pairs.select("a", "b").join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict = {}

        def of(key, text):
            if key not in last:
                if len(last) > 64:
                    last.clear()
                last[key] = shingle_set(text or "", words)
            return last[key]

        for batch in batches:
            keep = []
            for i, (a, b, ta, tb) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(4)))):
                x, y = of(a, ta), of(b, tb)
                same = len(x & y)
                if 100 * same >= percent * (len(x) + len(y) - same):
                    keep.append(i)
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], ["a", "b"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return written(both.select("a", "b", "ta", "tb").mapInArrow(linked, f"a {kind}, b {kind}").distinct(), "links")


def _alike_in_size(n: Column, m: Column, percent: int) -> Column:
    """Sets whose sizes differ more cannot reach the similarity."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _likely(percent: int) -> Column:
    """The bits ``s*`` and ``o*`` of two sketches agree as often as those of
    sets with the similarity do, less the margin."""
    p = (1 - percent / 100) / 2
    most = SKETCH * p + MARGIN * (SKETCH * p * (1 - p)) ** 0.5
    differ = sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"o{i}"))) for i in range(SKETCH // 64)), F.lit(0))
    return differ <= int(most)


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of sets of hashes (above the diagonal).
    A hash of few sets is counted pair by pair, one of many by matrix products."""
    m = len(sets)
    out = np.zeros((m, m), np.float32)
    held = np.concatenate(sets)
    order = np.argsort(held, kind="stable")
    row = np.repeat(np.arange(m), [len(x) for x in sets])[order]
    start = np.flatnonzero(np.concatenate(([True], np.diff(held[order]) != 0))) if len(held) else np.empty(0, np.int64)
    size = np.diff(np.concatenate((start, [len(held)])))
    for k in range(2, COMMON + 1):
        p, q = np.triu_indices(k, 1)
        at = start[size == k]
        for i in range(0, len(at), 1 + (1 << 22) // len(p)):
            some = row[at[i:i + 1 + (1 << 22) // len(p), None] + np.arange(k)]  # ascending in every line
            out += np.bincount((some[:, p] * m + some[:, q]).ravel(), minlength=m * m).reshape(m, m)
    many = np.flatnonzero(size > COMMON)
    for i in range(0, len(many), COLUMNS):
        some = many[i:i + COLUMNS]
        met = np.zeros((m, len(some)), np.float32)
        for column, c in enumerate(some):
            met[row[start[c]:start[c] + size[c]], column] = 1
        out += met @ met.T
    return out


def _new_links(sets: list[np.ndarray], block: np.ndarray, comp: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Linked pairs of two blocks (or inside one) that tie the components
    together which links tie together: no more than one pair a component."""
    n = np.array([len(x) for x in sets], np.float64)
    same = _shared(sets).astype(np.float64)
    linked = (same > 0) & (100 * same >= percent * (n[:, None] + n[None, :] - same)) & (comp[:, None] != comp[None, :])
    if block.min() != block.max():
        linked &= block[:, None] != block[None, :]
    names, label = np.unique(comp, return_inverse=True)
    root, found = list(range(len(names))), []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in np.argwhere(np.triu(linked, 1)).tolist():
        x, y = top(int(label[a])), top(int(label[b]))
        if x != y:
            root[y] = x
            found.append((a, b))
    return found


def _linked_in_blocks(left: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``(a, b)``: links between the components of ``left (band, rep, n, comp,
    lead)``, ``lead`` being one class of the band.  Enough of them to join all
    classes that linked pairs of a common band join."""
    # a class is tied to one of its leads, and its other leads (one a band) to that one: far fewer edges than rows
    ties = left.groupBy("rep").agg(F.min("lead").alias("b"), F.collect_set("lead").alias("leads"))
    ties = ties.select(F.explode(F.array_union("leads", F.array("rep"))).alias("a"), "b")
    cluster = components(ties.where("a != b").distinct())
    rows = left.join(cluster.select(F.col("id").alias("rep"), F.concat(F.lit("c"), F.col("comp").cast("string")).alias("unit")), "rep")

    def sizes(df: DataFrame) -> DataFrame:
        need = df.select("unit", "rep", "n").distinct().select("unit", "n").groupBy("unit").agg(F.count(F.lit(1)).alias("_m"), F.sum("n").alias("_s"))
        return need.select("unit", F.greatest(F.ceil(F.col("_m") / BLOCK), F.ceil(F.col("_s") / BLOCK_SHINGLES)).cast("int").alias("blocks"))

    # looked up are only clusters of several blocks: at most one for BLOCK classes, or BLOCK_SHINGLES of them
    large = written(sizes(rows).where("blocks > 1"), "large")
    large = bounded_broadcast(large, large.count())
    wide = large.where(F.col("blocks") > MAX_BLOCKS).select("unit", F.lit(True).alias("_wide"))
    band = F.concat(F.lit("b"), F.col("band").cast("string"))
    rows = rows.join(wide, "unit", "left").withColumn("unit", F.when(F.col("_wide"), band).otherwise(F.col("unit")))
    rows = written(rows.select("unit", "rep", "n", "comp").distinct(), "clusters")
    large = written(sizes(rows).where("blocks > 1"), "large")
    rows = rows.join(bounded_broadcast(large, large.count()), "unit", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = rows.select("unit", "rep", "comp", own.alias("block"),
                        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("unit", "rep", "comp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    met = dealt.join(texts.select(F.col("doc_id").alias("rep"), "text"), "rep")

    def linked(pdf: pd.DataFrame) -> pd.DataFrame:
        with np.errstate(over="ignore"):
            sets = [shingles(t or "", words) for t in pdf["text"]]
        pairs = _new_links(sets, pdf["block"].to_numpy(), pdf["comp"].to_numpy(), percent)
        rep = pdf["rep"].to_numpy()
        return pd.DataFrame({"a": rep[[a for a, _ in pairs]], "b": rep[[b for _, b in pairs]]})

    kind = texts.schema["doc_id"].dataType.simpleString()
    return met.groupBy("unit", "i", "j").applyInPandas(lambda pdf: linked(pdf), f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, n_shingles, component_id, kept)``.

    Documents are linked when 100 * intersection >= ``percent`` * union of
    their shingle sets; ``component_id`` is the smallest id that can be
    reached.  A null or wordless text has an empty set and no link.  Rows
    with the same id are one document; if their texts differ, it is linked
    where any of them is.  A row without an id can't be named by a link:
    it stays alone, ``component_id`` null and ``kept`` true.  Other columns
    are ignored; an empty table gives an empty result."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    named = src.where(F.col("doc_id").isNotNull())
    sigs = written(signatures(src, words), "signatures")
    full = sigs.where(F.col("fp").isNotNull() & F.col("doc_id").isNotNull())
    # one class per different set; equal sets have equal bands
    classes = written(full.groupBy("fp").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "bits")).alias("s"))
                      .select("fp", F.col("s.doc_id").alias("rep"), F.col("s.n_shingles").alias("n"), "s.bands", "s.bits"), "classes")
    rows = classes.select("rep", "n", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1).select("band")
    rows = written(rows.join(shared, "band").distinct(), "bands")
    ids = full.select("doc_id", "fp").join(classes.select("fp", "rep"), "fp").where(F.col("doc_id") != F.col("rep"))
    # one id with several sets (repeated ids) ties the sets' classes together
    links = written(ids.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
                    .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(), "links")
    comps = components(links)
    # the texts that can be compared: one shuffle of the documents for all rounds
    texts = written(named.join(rows.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
                    .groupBy("doc_id", F.xxhash64("text")).agg(F.first("text").alias("text")).select("doc_id", "text"), "texts")
    tested, spent = None, [rows, texts]

    def sketched(side: str) -> DataFrame:
        return classes.select("rep", *[F.col("bits")[i].alias(f"{side}{i}") for i in range(SKETCH // 64)])

    def members(columns: list, *more: Column) -> DataFrame:
        """The rows of bands that hold several components, with the band's ``columns``."""
        now = rows.join(comps.withColumnRenamed("id", "rep"), "rep", "left") \
            .select("band", "rep", "n", F.coalesce("comp", "rep").alias("comp"))
        ends = now.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), *columns).where(F.col("lo") != F.col("hi"))
        for condition in more:
            ends = ends.where(condition)
        return now.join(ends.drop("lo", "hi"), "band")

    for turn in range(PARTNER_ROUNDS):
        first = F.min(F.struct(F.xxhash64(F.lit(turn), "band", "rep").alias("h"), "rep", "n", "comp")).alias("p")
        # every round has a share of the bands: what one round links, the next need not compare
        now = members([first], F.pmod(F.xxhash64("band"), F.lit(PARTNER_ROUNDS)) == turn)
        met = now.select("rep", "n", "comp", F.col("p.rep").alias("b"), F.col("p.n").alias("m"), F.col("p.comp").alias("comp2"))
        met = met.where((F.col("comp") != F.col("comp2")) & _alike_in_size(F.col("n"), F.col("m"), percent)).select("rep", "b").distinct()
        met = met.join(sketched("s"), "rep").join(sketched("o").withColumnRenamed("rep", "b"), "b").where(_likely(percent))
        pairs = met.select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        spent.append(pairs)
        if pairs.limit(1).count() == 0:
            continue
        found = _confirmed(pairs, texts, words, percent)
        tested = pairs if tested is None else tested.union(pairs)
        spent.append(found)
        # components of what is known so far (old ones as edges to their smallest id) and the new links
        comps = components(comps.select(F.col("id").alias("a"), F.col("comp").alias("b")).where("a != b").union(found))
    left = written(members([F.min("rep").alias("lead")]), "open")
    spent.append(left)
    if left.limit(1).count():
        found = written(_linked_in_blocks(left, texts, words, percent).distinct(), "links")
        spent.append(found)
        comps = components(comps.select(F.col("id").alias("a"), F.col("comp").alias("b")).where("a != b").union(found))
    for table in spent:
        drop_written(table)
    label = classes.select("fp", "rep").join(comps.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("fp", F.coalesce("comp", "rep").alias("component_id"))
    linked = sigs.where(F.col("fp").isNotNull() & F.col("doc_id").isNotNull()).join(label, "fp") \
        .select("doc_id", "n_shingles", "component_id")
    alone = sigs.where(F.col("fp").isNull() | F.col("doc_id").isNull()) \
        .select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id",
                         text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: one of each
    group of linked rows, the one with the smallest id (rows without an id
    last, then by the row's content), and one of rows without words that are
    equal in all columns.  Every row is a document of its own, also where ids
    are null or repeated: only linked or equal rows are dropped."""
    # the columns travel under numbers, so their names meet no name used here
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = written(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()],
                               F.monotonically_increasing_id().alias("_doc_row")), "rows")
    content = F.sha2(F.to_json(F.struct(*names.values())), 256)
    found = near_duplicates(rows, words, percent, "_doc_row", names[text])
    named = rows.select(F.col("_doc_row").alias("doc_id"), F.col(names[doc_id]).alias("_id"), content.alias("_content"))
    group = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    kept = (found.join(named, "doc_id").groupBy(group.alias("_group"), F.when(group.isNull(), F.col("_content")).alias("_equal"))
            .agg(F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_content", "doc_id")).alias("_first"))
            .select(F.col("_first.doc_id").alias("_kept_row")))
    return (rows.join(kept, F.col("_doc_row") == F.col("_kept_row"), "left_semi")
            .select(*[F.col(n).alias(c) for c, n in names.items()]))
