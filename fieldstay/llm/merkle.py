"""A Merkle manifest of documents: nested leaf-rank intervals, proofs by containment joins, verification by folding."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.llm.storage import materialise, ranked

# Levels built, or joined, at once: a bucket covers at most 2 ** SPAN leaf ranks of its lowest level.
SPAN = 10
NODE = "grp long, level int, lo long, hi long, digest binary"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def sha(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _next_level(nodes: Column) -> Column:
    """Every two consecutive nodes (the last run may be one) under their digest; the parent covers their intervals."""

    def parent(i: Column) -> Column:
        first, second = F.get(nodes, i * 2), F.get(nodes, i * 2 + 1)
        return F.struct(
            first["lo"].alias("lo"),
            F.coalesce(second["hi"], first["hi"]).alias("hi"),
            sha(hexed(first["digest"]), F.coalesce(hexed(second["digest"]), F.lit(""))).alias("digest"),
        )

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) + 1) / 2).cast("int") - 1), parent)


def tree(leaves: DataFrame, heights: DataFrame, most: int) -> DataFrame:
    """``(grp, level, lo, hi, digest)`` of all nodes over ``(grp, lo, hi, digest)`` leaves, whose ``lo`` is the rank.
    ``heights`` has (grp, height); ``most`` is the largest. A job builds ``SPAN`` levels; a bucket has at most
    ``2 ** SPAN`` nodes."""
    bottoms, parts, base = leaves, [], 0
    while True:
        chunk = bottoms.groupBy("grp", F.shiftright("lo", base + SPAN).alias("bucket")).agg(
            F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("nodes")
        )
        climb = F.least(F.lit(SPAN), F.col("height") - base)
        steps = F.when(climb >= 1, F.sequence(F.lit(1), climb)).otherwise(F.array().cast("array<int>"))
        levels = F.aggregate(steps, F.array("nodes"), lambda done, _: F.concat(done, F.array(_next_level(F.element_at(done, -1)))))
        stacked = chunk.join(heights, "grp").select("grp", F.posexplode(levels).alias("up", "nodes"))
        found = materialise(
            stacked.select("grp", (F.col("up") + base).cast("int").alias("level"), F.explode("nodes").alias("node"))
            .select("grp", "level", "node.lo", "node.hi", "node.digest"),
            "nodes",
        )
        # The top of this job's levels is the bottom of the next one's.
        goes_on = base + SPAN < most
        parts.append(found.filter(F.col("level") < base + SPAN) if goes_on else found)
        if not goes_on:
            return reduce(DataFrame.unionByName, parts)
        bottoms, base = found.filter(F.col("level") == base + SPAN).drop("level"), base + SPAN


def _bucket(level: str) -> Column:
    return F.expr(f"shiftright(lo, {level})")


def siblings(nodes: DataFrame) -> DataFrame:
    """``(grp, level, lo, hi, left, right)`` of every node below a top: what its parent's interval has beyond the
    node's own, on either side, is the interval of a sibling (none where the run has one node)."""
    parents = nodes.select(F.col("grp").alias("pg"), (F.col("level") - 1).alias("pl"), _bucket("level").alias("pb"), F.col("lo").alias("plo"), F.col("hi").alias("phi"))
    inside = (F.col("grp") == F.col("pg")) & (F.col("level") == F.col("pl")) & (_bucket("level + 1") == F.col("pb"))
    under = nodes.drop("digest").join(parents, inside & (F.col("lo") >= F.col("plo")) & (F.col("hi") <= F.col("phi")))
    gap = F.when(F.col("lo") > F.col("plo"), F.struct(F.col("plo").alias("from"), F.col("lo").alias("to"))).when(
        F.col("hi") < F.col("phi"), F.struct(F.col("hi").alias("from"), F.col("phi").alias("to"))
    )
    wanted = under.select("grp", "level", "lo", "hi", gap.alias("gap"))
    others = nodes.select(F.col("grp").alias("og"), F.col("level").alias("ol"), F.col("lo").alias("from"), F.col("hi").alias("to"), "digest")
    match = (F.col("grp") == F.col("og")) & (F.col("level") == F.col("ol")) & (F.col("gap.from") == F.col("from")) & (F.col("gap.to") == F.col("to"))
    return wanted.join(others, match, "left").select(
        "grp", "level", "lo", "hi",
        F.when(F.col("from") < F.col("lo"), F.col("digest")).alias("left"),
        F.when(F.col("from") >= F.col("hi"), F.col("digest")).alias("right"),
    )


EMPTY_PATH = "array<struct<level:int,left:binary,right:binary>>"


def paths(bottoms: DataFrame, around: DataFrame, heights: DataFrame, above: DataFrame, most: int) -> DataFrame:
    """``(grp, lo, path, subroot)`` of every leaf ``(grp, lo)``: the siblings of the leaf and its ancestors, lowest
    first, and then ``above``'s path of the group.

    Ancestors are attached by containment joins bucketed by level. The joins go by bands of ``SPAN`` levels from
    the top: a band's lowest nodes meet their ancestors in it, then the node above them, whose path is known. So no
    node, the root's children included, meets more than ``2 ** SPAN`` rows.
    """
    bands = range(0, max(1, most), SPAN)
    known = None
    for base in reversed(bands):
        lowest = bottoms.select("grp", "lo") if base == 0 else around.filter(F.col("level") == base).select("grp", "lo")
        tall = heights.filter(F.col("height") > base) if base else heights
        top = F.least(F.col("height"), F.lit(base + SPAN))
        climbing = lowest.join(tall, "grp").select(
            "grp", "lo", F.explode_outer(F.when(top > base, F.sequence(F.lit(base), top - 1))).alias("level")
        )
        nodes = around.filter(F.col("level").between(base, base + SPAN - 1)).select(
            F.col("grp").alias("ag"), F.col("level").alias("al"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"), "left", "right",
            _bucket("level").alias("ab"),
        )
        holds = (F.col("grp") == F.col("ag")) & (F.col("level") == F.col("al")) & (_bucket("level") == F.col("ab"))
        holds &= (F.col("alo") <= F.col("lo")) & (F.col("lo") < F.col("ahi"))
        step = F.when(F.col("level").isNotNull(), F.struct("level", "left", "right"))
        own = climbing.join(nodes, holds, "left").groupBy("grp", "lo").agg(F.sort_array(F.collect_list(step)).alias("own"))
        low = heights.filter(F.col("height") <= base + SPAN).join(above, "grp")
        over = low.select("grp", F.lit(0).cast("long").alias("up"), "path", "subroot")
        if known is not None:
            over = over.unionByName(known.select("grp", F.shiftright("lo", base + SPAN).alias("up"), "path", "subroot"))
        known = materialise(
            own.withColumn("up", F.shiftright("lo", base + SPAN)).join(over, ["grp", "up"])
            .select("grp", "lo", F.concat("own", "path").alias("path"), "subroot"),
            "paths",
        )
    return known


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) gives with its siblings, level by level."""
    return F.aggregate(
        path, leaf, lambda at, s: F.sha2(F.concat(F.coalesce(hexed(s["left"]), F.lit("")), at, F.coalesce(hexed(s["right"]), F.lit(""))).cast("binary"), 256)
    )


def proof_text(path: Column) -> Column:
    """The siblings as hex text, joined; a level without one adds nothing."""
    return F.array_join(F.transform(path, lambda s: F.coalesce(hexed(F.coalesce(s["left"], s["right"])), F.lit(""))), "")


RESULT = "id {id}, leaf string, claimed string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(
    docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "lang",
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), claimed: Column | None = None,
) -> DataFrame:
    """``(id, leaf, claimed, subroot, root, proof_sha256, folded_root, verified)`` of every row.

    A leaf is the SHA-256 of the row's ``fields``, each ``-`` if null, else its byte count, a colon and the value.
    In each group leaves ascend by id (null first, ties by digest); every two consecutive nodes become the digest of
    theirs until one is left, the subroot; subroots in the order of the groups (null first) become the root alike.
    ``claimed`` is a second digest (hex) of the row as someone states it, by default and where null the leaf's own; it
    is folded with the siblings of the true leaf and verified against the root.

    Rows with equal ids are ordered by digest; repeated rows are leaves of their own. Other columns, whatever
    their names, are not read. Null and empty values have digests of their own. No rows give no rows.
    """
    leaf = sha(*[field(F.col(f"`{c}`")) for c in fields])
    stated = F.lit(None).cast("binary") if claimed is None else F.unhex(claimed)
    base = docs.select(F.col(f"`{group_col}`").alias("g"), F.col(f"`{id_col}`").alias("id"), leaf.alias("digest"), stated.alias("stated"))
    placed = materialise(ranked(materialise(base, "leaves"), ["g", "id", "digest"], "ranked-leaves"), "placed")
    groups = materialise(placed.groupBy("g").agg(F.min("pos").alias("first"), F.count("*").alias("n")), "groups")
    numbered = ranked(groups, ["g"], "ranked-groups").withColumnRenamed("pos", "grp")
    # The bits of the last rank; logarithms are not exact at powers of two.
    height = F.when(F.col("n") == 1, 0).otherwise(F.length(F.bin(F.col("n") - 1)))
    numbered = materialise(numbered.withColumn("height", height), "heights")
    id_type = docs.schema[id_col].dataType.simpleString()
    totals = numbered.agg(F.max("height"), F.count("*")).first()
    if not totals[1]:
        return docs.sparkSession.createDataFrame([], RESULT.format(id=id_type))
    heights = numbered.select("grp", "height")
    rows = placed.join(numbered.withColumnRenamed("g", "g2"), F.col("g").eqNullSafe(F.col("g2"))).select(
        "grp", (F.col("pos") - F.col("first")).alias("lo"), "id", "digest", F.coalesce("stated", "digest").alias("stated")
    )
    rows = materialise(rows, "leaf-ranks")
    leaves = rows.select("grp", "lo", (F.col("lo") + 1).alias("hi"), "digest")
    nodes = tree(leaves, heights, totals[0])
    subroots = materialise(
        nodes.join(heights, "grp").filter(F.col("level") == F.col("height")).select("grp", F.col("digest").alias("subroot")), "subroots"
    )

    # The groups are the leaves of one more tree.
    tops = subroots.select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("lo"), (F.col("grp") + 1).alias("hi"), F.col("subroot").alias("digest"))
    crown = (totals[1] - 1).bit_length()
    one = docs.sparkSession.range(1).select(F.col("id").alias("grp"), F.lit(crown).alias("height"))
    upper = tree(tops, one, crown)
    root = upper.filter(F.col("level") == crown).select(hexed(F.col("digest"))).first()[0]
    nothing = one.select("grp", F.array().cast(EMPTY_PATH).alias("path"), F.lit(None).cast("binary").alias("subroot"))
    crowned = paths(tops, materialise(siblings(upper), "upper-siblings"), one, nothing, crown)
    above = crowned.select(F.col("lo").alias("grp"), "path").join(subroots, "grp")

    known = paths(leaves, materialise(siblings(nodes), "siblings"), heights, above, totals[0])
    return rows.join(known, ["grp", "lo"]).select(
        "id",
        hexed(F.col("digest")).alias("leaf"),
        hexed(F.col("stated")).alias("claimed"),
        hexed(F.col("subroot")).alias("subroot"),
        F.lit(root).alias("root"),
        F.sha2(proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        folded(hexed(F.col("stated")), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
