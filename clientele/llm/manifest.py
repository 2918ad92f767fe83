"""A Merkle manifest of a data set, with nested intervals as labels.

Every row is a leaf. The leaves of a scope (a language) stand in a fixed order;
runs of eight nodes become a node until one is left, and the scopes' last nodes
are the leaves of one more tree. A node carries the interval of leaf ranks that
it covers. Which nodes a leaf hangs from is then a matter of containment: from
the top down, the nodes of a level meet those above in a join on bucket (the
rank divided by the level's width) where one interval contains the other, and of
a node's children those that lie before or after an interval are its siblings
on the way to the root.

All leaves of a run share their ancestors, so those are attached once per run
and a leaf adds the other leaves of its run. Texts are hashed where they are
read; only digests are shuffled. Ranks come from a range partitioning with
offsets, never from a window over a scope.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clientele.llm.common import ascii_lower
from clientele.sources.scratch import materialise

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a tree at most: 8^20 leaves.
LEVELS = 21


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def written(value: Column) -> Column:
    """A field as the hash takes it: its length in bytes and its value, or a dash."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(fields: list[Column]) -> Column:
    return sha256(F.concat(*[written(f) for f in fields]))


def lowered(text: Column, doc_id: Column) -> Column:
    """The trial's tampering: texts in lower case where 3 divides the checksum of the id."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0
    return F.when(F.coalesce(hit, F.lit(False)), ascii_lower(text)).otherwise(text)


def scope_of(lang: Column) -> Column:
    """A text that orders like the value, null first."""
    return F.coalesce(F.concat(F.lit("+"), lang), F.lit(""))


def ranked(rows: DataFrame, scope: str, order: list[str]) -> DataFrame:
    """Add ``rank`` within ``scope`` (from 0) and ``total``, its number of rows.

    ``rows`` must be the same whenever they are read. Offsets are one row per
    partition and scope, and rows meet them by both, so that a scope with most
    of the rows is no hot key.
    """
    placed = materialise(
        rows.withColumn("_row", F.monotonically_increasing_id())
        # rows equal in all else are cut as well
        .repartitionByRange(scope, *order, "_row")
        .sortWithinPartitions(scope, *order, "_row")
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33))
        .drop("_row")
    )
    own = W.partitionBy(scope)
    starts = (
        placed.groupBy("_part", scope)
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            scope,
            "_first",
            F.coalesce(F.sum("_rows").over(own.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.sum("_rows").over(own).alias("total"),
        )
    )
    return (
        placed.join(starts, ["_part", scope])
        .withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first"))
        .drop("_at", "_part", "_first", "_before")
    )


def run_digest(children: Column, total: Column, level: int) -> Column:
    """Hash of a run's digests; a node that is alone on its level stays what it is."""
    digests = F.transform(children, lambda c: c["digest"])
    return F.when(total > FAN ** (level - 1), sha256(F.array_join(digests, ""))).otherwise(digests[0])


def bucket_of(low: Column, level: int) -> Column:
    """Where the node of ``level`` that covers a rank stands on its level."""
    return F.floor(low / F.lit(FAN**level))


def levels_of(leaves: DataFrame, scope: str, payload: list[str]) -> list[DataFrame]:
    """The nodes from level 1 up: ``scope``, ``total``, ``low``, ``high``, ``children`` in order, ``digest``.

    The children of level 1 are leaves with ``payload``. A level has an eighth of
    the rows of the one below; levels go on while any scope has more than one
    node. The node of a lone leaf has the leaf's digest.
    """
    below = leaves.select(scope, "total", F.col("rank").alias("low"), (F.col("rank") + 1).alias("high"), *payload, "digest")
    most = leaves.agg(F.max("total")).first()[0] or 0
    found: list[DataFrame] = []
    for level in range(1, LEVELS):
        if level > 1:
            if FAN ** (level - 1) >= most:
                break
            below, payload = found[-1].where(F.col("total") > FAN ** (level - 1)), []
        child = F.struct("low", "high", *payload, "digest")
        children = F.array_sort(F.collect_list(child)).alias("children")
        grouped = below.groupBy(scope, "total", bucket_of(F.col("low"), level).alias("_bucket")).agg(children)
        found.append(
            materialise(
                grouped.select(
                    scope,
                    "total",
                    F.col("children")[0]["low"].alias("low"),
                    F.element_at("children", -1)["high"].alias("high"),
                    "children",
                    run_digest(F.col("children"), F.col("total"), level).alias("digest"),
                )
            )
        )
    return found


def covers_all() -> Column:
    return (F.col("low") == 0) & (F.col("high") == F.col("total"))


def tops_of(levels: list[DataFrame], scope: str) -> DataFrame:
    """The last node of every scope."""
    parts = [nodes.where(covers_all()).select(scope, "digest") for nodes in levels]
    return reduce(DataFrame.unionByName, parts)


def beside(children: Column, low: Column, high: Column) -> Column:
    """Digests before and after an interval among the children of a node that covers it."""
    joined = lambda keep: F.array_join(F.transform(F.filter(children, keep), lambda c: c["digest"]), "")
    return F.struct(
        joined(lambda c: c["high"] <= low).alias("left"), joined(lambda c: c["low"] >= high).alias("right")
    )


def paths_of(levels: list[DataFrame], ways: DataFrame, scope: str, payload: list[str], carried: list[str]) -> DataFrame:
    """Every leaf with ``payload``, ``digest``, the ``carried`` columns of ``ways`` and its ``path`` up.

    ``ways`` has one row per scope with the path from its last node up. From
    there ancestors are attached level by level: a node meets the one above by
    scope and bucket where the other's interval contains its own, and takes over
    its path behind its own step. No key has more than eight rows. A step is what
    stands to the left and to the right of the node in its run.
    """
    above: DataFrame | None = None
    for level in range(len(levels), 0, -1):
        nodes = levels[level - 1].drop("digest")
        here = nodes.where(covers_all()).join(ways, scope)
        if above is not None:
            upper = above.select(
                scope,
                F.col("low").alias("_low"),
                F.col("high").alias("_high"),
                F.col("children").alias("_children"),
                "path",
                *carried,
                bucket_of(F.col("low"), level + 1).alias("_bucket"),
            )
            inner = (
                nodes.where(~covers_all())
                .withColumn("_bucket", bucket_of(F.col("low"), level + 1))
                .join(upper, [scope, "_bucket"])
                .where((F.col("_low") <= F.col("low")) & (F.col("high") <= F.col("_high")))
                .withColumn(
                    "path", F.concat(F.array(beside(F.col("_children"), F.col("low"), F.col("high"))), "path")
                )
            )
            here = here.unionByName(inner.select(*here.columns))
        above = here
    leaf = F.col("_leaf")
    own = F.array(beside(F.col("children"), leaf["low"], leaf["high"]))
    return above.withColumn("_leaf", F.explode("children")).select(
        scope,
        *[leaf[p].alias(p) for p in payload],
        leaf["digest"].alias("digest"),
        *carried,
        F.when(F.col("total") > 1, F.concat(own, "path")).otherwise(F.col("path")).alias("path"),
    )


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings on the way up lead to."""
    return F.aggregate(path, start, lambda digest, at: sha256(F.concat(at["left"], digest, at["right"])))


def siblings_digest(path: Column) -> Column:
    """Hash of all siblings, from the leaf up and from left to right."""
    return sha256(F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), ""))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    ``tampered`` is the text that the data now hold; the manifest is that of
    ``text``. ``folded_root`` is recomputed from the leaf of what is there now
    and the siblings of the manifest; a changed row does not lead to the root.

    Only the columns of ``documents`` are read. A null field is a dash, unlike an
    empty text. Null languages are a scope of their own that comes first. Rows
    stand by id, null ids first, then by leaf; equal rows are leaves like others
    and have proofs of their own. A lone leaf is its scope's subroot, a lone
    subroot the root, and the proof of a lone leaf without other scopes is that
    of no siblings. An empty table gives no rows.
    """
    text = F.col("text") if tampered is None else tampered
    fields = [F.col(f) for f in FIELDS]
    now = [text if f == "text" else F.col(f) for f in FIELDS]
    hashed = materialise(
        docs.select(
            F.col("doc_id"),
            scope_of(F.col("lang")).alias("scope"),
            leaf(fields).alias("digest"),
            F.when(~text.eqNullSafe(F.col("text")), leaf(now)).alias("changed"),
        )
    )
    nothing = F.expr("CAST(array() AS array<struct<left: string, right: string>>)")
    levels = levels_of(ranked(hashed, "scope", ["doc_id", "digest"]), "scope", ["doc_id", "changed"])
    named = tops_of(levels, "scope").select(F.lit("").alias("all"), "scope", "digest")
    upper = levels_of(ranked(named, "all", ["scope"]), "all", ["scope"])
    root = tops_of(upper, "all").select("all", F.col("digest").alias("root"), nothing.alias("path"))
    ways = paths_of(upper, root, "all", ["scope"], ["root"]).select(
        "scope", F.col("digest").alias("subroot"), "root", "path"
    )
    path = F.col("path")
    return (
        paths_of(levels, materialise(ways), "scope", ["doc_id", "changed"], ["subroot", "root"])
        .select(
            "doc_id",
            F.col("digest").alias("leaf"),
            "subroot",
            "root",
            siblings_digest(path).alias("proof_sha256"),
            folded(F.coalesce("changed", "digest"), path).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
