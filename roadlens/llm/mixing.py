"""Mixing sources to target weights by fixed-length blocks (operator 3).

DataFrame expressions only.  The words of a source form one stream (documents
in a fixed pseudorandom order) that is cut into blocks of ``BLOCK`` words.
The output is a list of slots, in shards of ``SHARD`` slots.  Every slot draws
its source by itself, so the source counts of a shard are one multinomial
draw; a source's slots are numbered through over the shards, and the slot
with number ``k`` reads block ``perm(k mod n)`` of the source's ``n`` blocks,
``perm`` being a pseudorandom permutation computed from the index alone.
Blocks and slots then meet in one join on (source, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlens.llm.common import BLANK_RE, WORD_RE, running_start, written

#: Words of a block, slots of an output shard.
BLOCK, SHARD = 32, 1024
#: Buckets of a source's running sums: at least so many, and one for so many documents.
BUCKETS, BUCKET_ROWS = 1024, 50_000
#: Source weights in the order of the sources' names (fixed values).
WEIGHTS = (5.0, 2.0, 1.0)
#: A source is used this many times at most.
MAX_PASSES = 3
#: Cells of the table that turns a uniform number into a source.
CELLS = 4096
SEED = "mix"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("bigint")


def unit(*parts: Column) -> Column:
    """A pseudorandom number in [0, 1) that depends on ``parts`` only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11) / F.lit(float(1 << 53))


def source_targets(sized: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """``(source, sid, source_size, target)``: sources in the order of their
    names' code points (null last) take ``weights`` in turn and share the
    words of all sources; a target stops at ``max_passes`` times its source,
    and the excess goes to the others by weight until none is above.

    That is the water level ``min(cap, level * weight)``: sources by
    ``cap / weight`` ascending, a source is capped while its ratio lies below
    the level that the sources after it would share.  One row per source is
    sorted in one task; the documents are only summed."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.asc_nulls_last("source"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights)).cast("int") + 1)
    rows = per.withColumn("sid", (F.row_number().over(named) - 1).cast("bigint")).withColumn("w", w) \
        .withColumn("cap", F.col("source_size") * float(max_passes))
    filled = Window.orderBy(F.col("cap") / F.col("w"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rows = rows.withColumns({"cap_before": F.coalesce(F.sum("cap").over(filled), F.lit(0.0)),
                             "w_before": F.coalesce(F.sum("w").over(filled), F.lit(0.0)),
                             "w_all": F.sum("w").over(every),
                             "all": F.sum("source_size").over(every).cast("double")})
    # what is left for this source and those after it, by weight
    rows = rows.withColumn("level", (F.col("all") - F.col("cap_before")) / (F.col("w_all") - F.col("w_before")))
    rows = rows.withColumn("capped", F.col("cap") <= F.col("level") * F.col("w"))
    # past the first source that isn't capped the level only falls
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(every)
    return rows.withColumn("water", level).select(
        "source", "sid", "source_size",
        F.when(F.col("capped"), F.col("cap")).otherwise(F.col("water") * F.col("w")).alias("target"))


def permuted(k: Column, n: Column, sid: Column) -> Column:
    """Place ``k mod n`` of a pseudorandom permutation of 0..n-1 that belongs
    to the source.  Four rounds of a bijection on the largest power of two in
    ``n`` (odd multiplier and folded shift, modulo the power) and a rotation
    by a pseudorandom distance, as a fold over the rounds' constants."""
    bits = F.floor(F.log2(n.cast("double") + 0.5)).cast("int")
    h = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)
    half = F.greatest(F.floor((bits + 1) / 2), F.lit(1)).cast("int")
    rounds = F.array(*[F.struct(
        (F.pmod(F.xxhash64(F.lit(f"{SEED}-odd-{r}"), sid), F.lit(1 << 22)) * 2 + 1).alias("odd"),
        F.pmod(F.xxhash64(F.lit(f"{SEED}-turn-{r}"), sid), n).alias("turn"),
        h.alias("h"), half.alias("half"), n.alias("n")) for r in range(4)])

    def one(x: Column, r: Column) -> Column:
        y = F.pmod(x * r["odd"], r["h"])
        folded = y.bitwiseXOR(F.call_function("shiftright", y, r["half"]))
        return F.pmod(F.when(x < r["h"], folded).otherwise(x) + r["turn"], r["n"])

    return F.aggregate(rounds, F.pmod(k, n), one)


def blocks_wanted(targets: DataFrame, block: int = BLOCK, max_passes: int = MAX_PASSES) -> DataFrame:
    """Adds ``n_blocks`` and ``slots`` per source: full passes over all blocks
    as often as the target holds them, then single blocks for the rest."""
    n = F.ceil(F.col("source_size") / F.lit(float(block))).cast("bigint")
    passes = F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)) + 1e-12).cast("bigint")
    rest = F.round((F.col("target") - passes * F.col("source_size")) / block).cast("bigint")
    return targets.withColumns({"n_blocks": n, "slots": F.least(passes * n + rest, n * max_passes)})


def draw_slots(wanted: DataFrame, shard: int = SHARD) -> DataFrame:
    """``(sid, n_blocks, shard, k)``: the slots of all shards, ``k`` numbering
    the slots of a source; ``wanted`` is a written table.

    A source gets its wanted slots in two parts.  Most come from the draw: the
    drawn shards' slots pick sources with probability in proportion to the
    wanted slots less a reserve of four standard deviations, so the counts per
    shard are multinomial.  The last shards settle what a source still lacks
    after the draw (a draw above the wanted number is cut there), so the
    totals come out as wanted."""
    spark = wanted.sparkSession
    p = F.col("slots") / F.sum("slots").over(Window.partitionBy())
    spare = F.ceil(4 * F.sqrt(F.col("slots") * (1 - p))) + 1
    drawn = wanted.where("slots > 0").withColumn("draw", F.greatest(F.col("slots") - spare, F.lit(0)).cast("bigint"))
    n_draw = int(drawn.agg(F.sum("draw")).first()[0] or 0)
    n_shards = -(-n_draw // shard)

    # a uniform number picks a cell, and the cell lists the few sources in it
    share = F.col("draw") / F.lit(float(max(n_draw, 1)))
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    ends = drawn.where("draw > 0").withColumn("hi", F.sum("draw").over(upto) / F.lit(float(max(n_draw, 1))))
    first_cell = F.greatest(F.floor((F.col("hi") - share) * CELLS), F.lit(0))
    last_cell = F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1))
    cells = (ends.select(F.explode(F.sequence(first_cell, last_cell)).alias("cell"), F.struct("hi", "sid").alias("e"))
             .groupBy("cell").agg(F.array_sort(F.collect_list("e")).alias("ends")))
    slots = spark.range(n_draw).select("id", F.floor(F.col("id") / shard).alias("shard"), unit(F.col("id")).alias("u")) \
        .withColumn("cell", F.floor(F.col("u") * CELLS))
    above = F.filter("ends", lambda e: e["hi"] > F.col("u"))
    own = F.when(F.size(above) > 0, F.get(above, F.lit(0))).otherwise(F.element_at("ends", -1))
    picked = slots.join(cells, "cell").select("shard", "id", own["sid"].alias("sid"))

    counts = written(picked.groupBy("sid", "shard").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    starts = running_start(counts, ["sid"], "n", ["shard"], "first", F.floor(F.col("shard") / 1024), [])
    inside = Window.partitionBy("sid", "shard").orderBy("id")
    made = (picked.withColumn("i", F.row_number().over(inside) - 1)
            .join(starts.select("sid", "shard", "first"), ["sid", "shard"])
            .join(wanted.select("sid", "n_blocks", "slots"), "sid")
            .withColumn("k", F.col("first") + F.col("i")).where("k < slots").select("sid", "n_blocks", "shard", "k"))
    had = counts.groupBy("sid").agg(F.sum("n").alias("had"))
    lack = (wanted.where("slots > 0").join(had, "sid", "left").withColumn("had", F.coalesce("had", F.lit(0)))
            .where("had < slots").select("sid", "n_blocks", F.explode(F.expr("sequence(had, slots - 1)")).alias("k"))
            .select("sid", "n_blocks", (F.lit(n_shards) + F.floor(F.col("k") / shard)).cast("bigint").alias("shard"), "k"))
    return made.unionByName(lack)


def mix(sized: DataFrame, weights=WEIGHTS, block: int = BLOCK, shard: int = SHARD, max_passes: int = MAX_PASSES):
    """``(targets, parts)`` of a written table ``(row, doc_id, source, size,
    mark)`` of documents.

    ``targets``: as ``source_targets``.  ``parts``: one row per slot and
    document that its block touches, ``(sid, row, doc_id, mark, shard, k,
    pass, from_word, n_words)``: the mix itself, in words of its documents.
    Documents without words take no part."""
    targets = written(source_targets(sized, weights, max_passes), "mix-targets")
    wanted = written(blocks_wanted(targets, block, max_passes), "mix-wanted")
    rows = sized.where("size > 0").join(targets.select(F.col("source").alias("_src"), "sid"),
                                        F.col("source").eqNullSafe(F.col("_src")))
    buckets = max(BUCKETS, sized.count() // BUCKET_ROWS)
    placed = running_start(rows, ["sid"], "size", ["doc_id", "mark", "row"], "start",
                           F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "mark"), F.lit(buckets)), [])
    touched = F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")
    segments = placed.select("*", F.explode(touched).alias("block"))
    lo = F.greatest(F.col("start"), F.col("block") * block)
    hi = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    segments = segments.select("sid", "block", "row", "doc_id", "mark", (lo - F.col("start")).alias("from_word"),
                               (hi - lo).alias("n_words"))
    slots = draw_slots(wanted, shard).select(
        "sid", permuted(F.col("k"), F.col("n_blocks"), F.col("sid")).alias("block"), "shard", "k", F.expr("k div n_blocks").cast("int").alias("pass"))
    return targets, segments.join(slots, ["sid", "block"])


def sizes(docs: DataFrame, mark: Column, doc_id: str, source: str, text: str) -> DataFrame:
    """The written table that ``mix`` reads."""
    return written(docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
                               F.col(source).alias("source"), words_of(F.col(text)).alias("size"), mark.alias("mark")),
                   "mix-sizes")


def mixed_sizes(docs: DataFrame, weights=WEIGHTS, doc_id: str = "doc_id", source: str = "source", text: str = "text",
                **options) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, size, source_size, target,
    taken)``, ``taken`` being its words in the mix, repeats counted (three
    times its size at most).  A null text has size 0 and gives nothing; null
    sources are one source, the last; null and repeated ids and rows are kept
    row by row; other columns are ignored; an empty table gives an empty
    result.  Equal input gives equal output."""
    sized = sizes(docs, F.xxhash64(F.col(text)), doc_id, source, text)
    targets, parts = mix(sized, weights, **options)
    got = parts.groupBy("row").agg(F.sum("n_words").alias("taken"))
    t = targets.select(F.col("source").alias("_src"), "source_size", "target")
    return (sized.select("row", "doc_id", "source", "size").join(got, "row", "left")
            .join(t, F.col("source").eqNullSafe(F.col("_src")))
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, doc_id: str = "doc_id", source: str = "source",
                    text: str = "text", n_chars: str = "n_chars", **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: one row per document
    and pass in which blocks of it were taken, its text cut down to the taken
    blocks (as it stands when all were), ``n_chars`` (where there is such a
    column) set to the new length.  Rows equal in every column are one
    document here, with the words that all of them have in the mix."""
    # maps have no hash of their own; the columns travel under numbers, so their names meet no name used here
    cols = [F.col(f"`{c}`") for c in docs.columns]
    mark = F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in t else c for c, (_, t) in zip(cols, docs.dtypes)])
    sized = sizes(docs, mark, doc_id, source, text)
    _, parts = mix(sized, weights, **options)
    takes = parts.groupBy("doc_id", "mark", "row", "pass").agg(
        F.array_sort(F.collect_list(F.struct("from_word", "n_words"))).alias("_parts"), F.sum("n_words").alias("_n"))
    takes = takes.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key2"), F.col("mark").alias("_mark2"), "_parts", "_n")
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    one = docs.select(*[c.alias(n) for c, n in zip(cols, names.values())], mark.alias("_mark"),
                      F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("_key")).dropDuplicates(["_key", "_mark"])
    whole = F.col(names[text])
    pieces = F.regexp_extract_all(whole, F.lit(BLANK_RE.replace("+", "*") + WORD_RE), F.lit(0))
    cut = one.join(takes, (F.col("_mark") == F.col("_mark2")) & (F.col("_key") == F.col("_key2"))).withColumn("_pieces", pieces)
    taken = F.concat_ws("", F.flatten(F.transform("_parts", lambda x: F.slice(
        F.col("_pieces"), (x["from_word"] + 1).cast("int"), x["n_words"].cast("int")))))
    cut = cut.withColumn("_text", F.when(F.col("_n") == F.size("_pieces"), whole).otherwise(taken))
    new = {text: F.col("_text")} | ({n_chars: F.length("_text").cast(docs.schema[n_chars].dataType)} if n_chars in docs.columns else {})
    return cut.select(*[new.get(c, F.col(n)).alias(c) for c, n in names.items()])
