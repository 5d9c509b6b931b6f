"""A Merkle tree over a table: one subtree per group, and a tree over the subroots.

Nodes of a level are numbered from 0 within their group. Every level is joined to itself on a computed sibling number
(XOR 1 where runs have two nodes, slot offsets otherwise), so each node holds the digests to its left and right in its
run; the rows of slot 0 emit the next level. Proofs come down the same way: a node's path is its own siblings and then
its parent's path, so a level moves as many paths as it has parents.

A digest is SHA-256 over lowercase hex text; tables hold it as 32 bytes. A leaf takes every given column in order: `-`
for null, else the UTF-8 length, `:`, and the value as text. Rows of one group lie by id, null first, then by leaf, so
repeated rows have a defined place. A null group is a group of its own, before all others. A lone leaf is its group's
subroot, a lone subroot is the root. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eduflow.llm.common import stored

#: What a leaf takes, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def digest(nodes: Column) -> Column:
    """Of one or more digests laid end to end: the digest of their hex text."""
    return F.unhex(F.sha2(hex_text(nodes), 256))


def leaf(values: list[Column]) -> Column:
    texts = [v.cast("string") for v in values]
    framed = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*framed), 256))


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """Adds idx (place in the order within group `g`, from 0) and n (rows of the group).

    The rows are dealt out by range of the whole order, so a group of any size is spread over tasks; equal rows are
    spread too. A group's window is over one row per task.
    """
    keys = ["g", *order, "salt"]
    ranged = nodes.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(ranged.drop("salt").withColumn("place", F.monotonically_increasing_id()))
    placed = placed.withColumn("part", F.shiftright("place", 33))
    whole = Window.partitionBy("g")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part", "g").agg(F.min("place").alias("first"), F.count("*").alias("here")).select(
        "part", "g", (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(whole).alias("n"))
    return placed.join(parts, ["part", "g"]).withColumn("idx", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Adds `before` and `after`: the digests to the left and right in a node's run, laid end to end."""
    slot = F.col("idx") % arity
    out, at, nothing = nodes, {}, F.unhex(F.lit(""))
    for shift in range(1, arity):
        other = F.col("idx").bitwiseXOR(F.lit(1).cast("long")) if arity == 2 else (
            F.col("idx") - slot + (slot + shift) % arity)
        siblings = nodes.where("n > 1").select(F.col("g").alias("other_g"), F.col("idx").alias("other"),
                                               F.col("hash").alias(f"hash{shift}"))
        out = out.join(siblings, (F.col("g") == F.col("other_g")) & (other == F.col("other")), "left").drop("other_g", "other")
    for place in range(arity):
        found = [F.when((slot + shift) % arity == place, F.col(f"hash{shift}")) for shift in range(1, arity)]
        at[place] = F.coalesce(*found, nothing)
    return out.withColumns({
        "before": F.concat(nothing, *[F.when(place < slot, at[place]).otherwise(nothing) for place in at]),
        "after": F.concat(nothing, *[F.when(place > slot, at[place]).otherwise(nothing) for place in at]),
    }).drop(*[f"hash{shift}" for shift in range(1, arity)])


def climbed(nodes: DataFrame, arity: int) -> list[DataFrame]:
    """The levels from the leaves (g, idx, n, hash, and more) up to where every group has one node; each is stored."""
    nodes = stored(nodes)
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = []
    while True:
        levels.append(stored(with_siblings(nodes, arity)))
        if most <= 1:
            return levels
        most = -(-most // arity)
        run = levels[-1].where((F.col("n") > 1) & (F.col("idx") % arity == 0))
        nodes = run.select("g", F.floor(F.col("idx") / arity).alias("idx"), F.ceil(F.col("n") / arity).alias("n"),
                           digest(F.concat("hash", "after")).alias("hash"))


def tops(levels: list[DataFrame]) -> DataFrame:
    """g, height and hash of the last node of each group."""
    out = None
    for height, level in enumerate(levels):
        last = level.where("n = 1").select("g", F.lit(height).alias("height"), "hash")
        out = out.union(last) if out else last
    return out


def descended(levels: list[DataFrame], ends: DataFrame, arity: int) -> DataFrame:
    """The leaves with `path`: the siblings at every level from the leaf up, then what `ends` (g, height, path, top) has."""
    paths = None
    for height in reversed(range(len(levels))):
        over = ends.where(F.col("height") == height).select(
            F.col("g").alias("over_g"), F.lit(-1).cast("long").alias("over"), F.col("path").alias("above"), "top")
        if paths is not None:
            over = over.union(paths.select("g", "idx", "path", "top"))
        up = F.when(F.col("n") > 1, F.floor(F.col("idx") / arity)).otherwise(F.lit(-1))
        joined = levels[height].join(over, (F.col("g") == F.col("over_g")) & (up == F.col("over")))
        own = F.array(F.struct("before", "after"))
        paths = joined.withColumn("path", F.when(F.col("n") > 1, F.concat(own, "above")).otherwise(F.col("above"))).drop(
            "above", "over_g", "over", "before", "after")
    return paths


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, run: digest(F.concat(run["before"], node, run["after"])))


def manifest(rows: DataFrame, group: Column, order: list[str], arity: int = 2) -> DataFrame:
    """`rows` (with a binary `leaf`), each with `subroot`, `root` and `path`, an array of (before, after) digests.

    `group` may be null; groups lie by their text, null first. No column of `rows` may be named g, n, idx, hash,
    before, after, path, top or height.
    """
    key = F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group.cast("string")))
    leaves = numbered(rows.withColumn("g", key).withColumn("hash", F.col("leaf")), *order, "leaf")
    levels = climbed(leaves, arity)
    subroots = tops(levels).select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("height").alias("tall"), "hash")
    upper = climbed(numbered(subroots, "name"), arity)
    nothing = F.array().cast("array<struct<before:binary,after:binary>>")
    crown = tops(upper).select("g", "height", nothing.alias("path"), F.col("hash").alias("top"))
    ends = stored(descended(upper, crown, arity).select(
        F.col("name").alias("g"), F.col("tall").alias("height"), "path", F.struct(F.col("hash").alias("subroot"), F.col(
            "top").alias("root")).alias("top")))
    return descended(levels, ends, arity).select(*rows.columns, "top.subroot", "top.root", "path")


def verified(docs: DataFrame, every: int = 7, arity: int = 2) -> DataFrame:
    """Proofs of all documents against the manifest, after one is added to `n_chars` of some of them.

    Tampered are documents whose id's CRC-32 `every` divides; a null `n_chars` stays, so its leaf does too, and a null
    id is never tampered.
    """
    values = [F.col(c) for c in FIELDS]
    changed = [F.col("n_chars").cast("decimal(38,0)") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % every == 0, F.lit(False))
    rows = docs.select("doc_id", F.col("lang").alias("group"), leaf(values).alias("leaf"),
                       F.when(hit, leaf(changed)).alias("tampered"))
    found = manifest(rows, F.col("group"), ["doc_id"], arity)
    siblings = F.array_join(F.transform("path", lambda run: hex_text(F.concat(run["before"], run["after"]))), "")
    again = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.withColumn("folded", again).select(
        "doc_id", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"), F.sha2(siblings, 256).alias("proof_sha256"),
        hex_text(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
