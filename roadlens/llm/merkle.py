"""Merkle manifest of a document table, with a proof for every row (operator 13).

A row's leaf is the SHA-256 of its length-prefixed columns.  The leaves of a
language, by id, are hashed in runs of ``FAN`` into the next level until one
node is left; these subroots, by language, are hashed likewise into the root.

Proofs are found by pointer jumping.  Every inner node holds a pointer to an
ancestor and the sibling segments on the way to it: the parent at first.  A
self-join then hands every node its ancestor's segments and pointer, so the
distance doubles, and after log2(depth) joins all pointers stand at the root.
Nodes that have arrived take no part any more, so the root is no hot key.
The leaves jump last, in one join with their parents.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from roadlens.llm.common import drop_written, ranked, written
from roadlens.plans import bounded_broadcast

#: Nodes of a run.
FAN = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Jump targets that may be broadcast: each holds a few segments of at most 448 characters.
MAX_TARGETS = 2048


def _sha(x: Column) -> Column:
    return F.sha2(x, 256)


def leaf_hash(columns: list[Column]) -> Column:
    """Every value as ``-`` if null, else its UTF-8 length, ``:``, the value."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"),
                                                              c.cast("string"))) for c in columns]
    return _sha(F.concat(*parts))


def is_tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def _node(tree: Column, level: int, place: Column) -> Column:
    return F.concat(F.lit(f"{level}|"), place.cast("string"), F.lit("|"), tree)


def _grow(nodes: DataFrame, levels: list[DataFrame]) -> list[DataFrame]:
    """Appends to ``levels`` the tables ``(tree, place, hash, n, level, id,
    kids)`` of the nodes above ``nodes (tree, place, hash, n)``; ``n``: nodes
    of the tree on this level."""
    most, level = nodes.agg(F.max("n")).first()[0] or 0, 0
    while most > 1:
        most, level = -(-most // FAN), level + 1
        run = (nodes.where("n > 1").groupBy("tree", "n", F.floor(F.col("place") / FAN).alias("up"))
               .agg(F.sort_array(F.collect_list(F.struct("place", "hash"))).alias("run")))
        run = run.select("tree", F.col("up").alias("place"), F.col("run.hash").alias("kids"),
                         F.ceil(F.col("n") / FAN).alias("n"))
        nodes = written(run.select("tree", "place", _sha(F.concat_ws("", "kids")).alias("hash"), "n",
                                   F.lit(level).alias("level"), _node(F.col("tree"), level, F.col("place")).alias("id"), "kids"),
                        "level")
        levels.append(nodes)
    return levels


@dataclass(frozen=True)
class Manifest:
    """``proofs``: ``(doc_id, lang, place, leaf, changed, path)`` per row, the
    ``path`` an array of ``(before, after, top)``: the siblings' digests to the
    left and right on every level, ``top`` above the subroot.  ``root`` is null
    where the table is empty."""
    proofs: DataFrame
    root: str | None


def _parents(nodes: DataFrame, tops: DataFrame, level: int) -> DataFrame:
    """``nodes (tree, place, n, ...)`` of a level with ``up``, the id of the
    parent (null: the root), ``slot``, the place in the run, and ``top``."""
    last = nodes.join(tops.select(F.col("tree").alias("_t"), F.col("place").alias("_p"), F.col("n").alias("_langs")),
                      (F.col("n") == 1) & (F.col("tree") == F.col("_t")), "left")
    up = (F.when(F.col("n") > 1, _node(F.col("tree"), level + 1, F.floor(F.col("place") / FAN)))
          .when(F.col("_langs") > 1, _node(F.lit(""), 1, F.floor(F.col("_p") / FAN))))
    slot = F.when(F.col("n") > 1, F.col("place") % FAN).otherwise(F.col("_p") % FAN).cast("int")
    return last.select(*nodes.columns, up.alias("up"), slot.alias("slot"), ((F.col("n") == 1) | (F.col("tree") == "")).alias("top"))


def _segment(kids: Column, slot: Column, top: Column) -> Column:
    return F.struct(F.concat_ws("", F.slice(kids, F.lit(1), slot)).alias("before"),
                    F.concat_ws("", F.slice(kids, slot + 2, F.lit(FAN))).alias("after"), top.alias("top"))


def build(docs: DataFrame, columns: tuple[str, ...] = COLUMNS) -> Manifest:
    """The manifest of ``docs``; ``columns`` names its id, source, language,
    length and text.

    Leaves ascend by id (null first; rows of one id by their digest, equal
    rows in any order, which changes no digest); the languages by their UTF-8
    bytes, null first.  ``changed`` is the leaf with ``A-Z`` of the text in lower
    case where the id's CRC-32 divides by 3 (never for a null id), else the
    leaf again.  Texts may be null, empty or of any length, other columns are
    ignored, and an empty table gives no rows and no root."""
    doc_id, source, lang, n_chars, text = [F.col(f"`{c}`") for c in columns]
    leaf = leaf_hash([doc_id, source, lang, n_chars, text])
    changed = F.when(is_tampered(doc_id), leaf_hash([doc_id, source, lang, n_chars, lower_ascii(text)])).otherwise(leaf)
    tree = F.when(lang.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), lang.cast("string")))
    rows = docs.select(doc_id.alias("doc_id"), tree.alias("tree"), lang.alias("lang"), leaf.alias("hash"), changed.alias("changed"))
    rows = ranked(rows, ["tree"], ["doc_id", "hash"], "place")
    sizes = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.first("lang").alias("lang"))
    # one row a language; beyond the planner's broadcast limit the hot language is a skewed join, which it splits
    leaves = written(rows.join(sizes.select("tree", "n"), "tree").select("tree", "place", "hash", "n", "doc_id", "lang", "changed"),
                     "leaves")
    drop_written(rows)
    low = _grow(leaves.select("tree", "place", "hash", "n"), [])
    subroots = reduce(DataFrame.unionByName, [x.where("n = 1").select("tree", "hash") for x in [leaves, *low]])
    tops = ranked(subroots, [], ["tree"], "place")
    langs = tops.count()
    tops = tops.withColumn("n", F.lit(langs).cast("bigint"))
    high = _grow(tops.select(F.lit("").alias("tree"), "place", "hash", "n"), [])
    every = [*low, *high]
    if not every:  # at most one row
        first = leaves.select("hash").first()
        path = F.array().cast("array<struct<before:string,after:string,top:boolean>>")
        return Manifest(leaves.select("doc_id", "lang", "place", F.col("hash").alias("leaf"), "changed", path.alias("path")),
                        first and first[0])
    root, root_id = every[-1].where("n = 1").select("hash", "id").first() if high else \
        reduce(DataFrame.union, [x.where("n = 1").select("hash", "id") for x in low]).first()
    # of every inner node the segment to its parent, then jumps of doubled length
    inner = [_parents(x, tops, i + 1) for part in (low, high) for i, x in enumerate(part)]
    inner = written(reduce(DataFrame.unionByName, inner), "inner")
    parent = inner.select(F.col("id").alias("up"), F.col("kids").alias("_run"))
    steps = (inner.where("up IS NOT NULL").join(parent, "up")
             .select("id", "up", F.array(_segment(F.col("_run"), F.col("slot"), F.col("top"))).alias("path")))
    start = inner.where("up IS NULL").select("id", F.col("id").alias("up"),
                                             F.array().cast("array<struct<before:string,after:string,top:boolean>>").alias("path"))
    state, distance, depth = written(steps.unionByName(start), "paths"), 1, len(low) + len(high) - 1
    while distance < depth:
        arrived, away = state.where(F.col("up") == root_id), state.where(F.col("up") != root_id)
        wanted = away.select(F.col("up").alias("id")).distinct()
        target = state.join(wanted, "id", "left_semi")
        target = bounded_broadcast(target.select(F.col("id").alias("up"), F.col("up").alias("_far"), F.col("path").alias("_on")),
                                   wanted.limit(MAX_TARGETS + 1).count(), MAX_TARGETS)
        jumped = away.join(target, "up").select("id", F.col("_far").alias("up"), F.concat("path", "_on").alias("path"))
        new = written(arrived.unionByName(jumped), "paths")
        drop_written(state)
        state, distance = new, 2 * distance
    whole = inner.select(F.col("id").alias("up"), "kids").join(state.select(F.col("id").alias("up"), "path"), "up")
    own = _parents(leaves, tops, 0)
    path = F.concat(F.array(_segment(F.col("kids"), F.col("slot"), F.col("top"))), F.col("path"))
    proofs = own.join(whole, "up").select("doc_id", "lang", "place", F.col("hash").alias("leaf"), "changed", path.alias("path"))
    for x in every:
        drop_written(x)
    return Manifest(proofs, root)


def folded(leaf: Column, path: Column) -> Column:
    """The digest that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda acc, s: _sha(F.concat(s["before"], acc, s["after"])))


def proof_digest(path: Column) -> Column:
    return _sha(F.concat_ws("", F.transform(path, lambda s: F.concat(s["before"], s["after"]))))


def checked(manifest: Manifest) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``:
    every row's proof, folded from its changed leaf and compared with the root."""
    path, root = F.col("path"), F.lit(manifest.root).cast("string")
    below = F.filter(path, lambda s: ~s["top"])
    rows = manifest.proofs.select("doc_id", "leaf", folded(F.col("leaf"), below).alias("subroot"), root.alias("root"),
                                  proof_digest(path).alias("proof_sha256"), folded(F.col("changed"), path).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
