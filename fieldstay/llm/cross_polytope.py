"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations, with several probes a table."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstay.llm.components import stars
from fieldstay.llm.storage import map_arrow, materialise, release

# A bucket's vectors are compared in blocks of about this many.
BLOCK = 1024
# So many of a rotation's largest coordinates take part in probes, in so many combinations.
TOPS, MOST_CHOICES = 6, 256
SEED = 20_111
# Products this near the threshold are computed anew with exactly rounded sums.
MARGIN = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles, scaled to a largest component of 1 and then to length 1."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row; the length is a power of two."""
    n, size = rows.shape
    step = 1
    while step < size:
        pairs = rows.reshape(n, size // (2 * step), 2, step)
        first, second = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack([first + second, first - second], axis=2).reshape(n, size)
        step *= 2
    return rows / math.sqrt(size)


def rotate(rows: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform."""
    signs = np.random.default_rng(seed)
    for _ in range(3):
        rows = hadamard(rows * signs.choice((-1.0, 1.0), rows.shape[1]))
    return rows


def _choices(hashes: int) -> np.ndarray:
    """Combinations of axes by their ranks, those nearest to the best first; at most ``MOST_CHOICES``."""
    found: list[tuple[int, ...]] = [()]
    for _ in range(hashes):
        longer = [(*c, rank) for c in found for rank in range(TOPS)]
        found = sorted(longer, key=lambda c: (sum(c), c))[:MOST_CHOICES]
    return np.array(found, dtype=np.int64)


def probes_of(vectors: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """Bucket numbers of every unit vector, ``tables * probes`` of them.

    A hash is the signed axis nearest to the rotated vector. A table joins ``hashes`` of them; its probes are the
    combinations of nearest axes that lose least against the best one.
    """
    n, length = vectors.shape
    size = max(8, 1 << (length - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :length] = vectors
    choices = _choices(hashes)
    out = []
    for table in range(tables):
        loss, code = np.zeros((n, len(choices))), np.full((n, len(choices)), table + 1, dtype=np.uint64)
        for h in range(hashes):
            turned = rotate(padded, SEED + 1000 * table + h)
            height = np.abs(turned)
            axes = np.argsort(-height, axis=1, kind="stable")[:, :TOPS]
            top = np.take_along_axis(height, axes, 1)
            signed = (2 * axes + (np.take_along_axis(turned, axes, 1) < 0)).astype(np.uint64)
            loss += ((top[:, :1] - top) ** 2)[:, choices[:, h]]
            # A product with an odd number mixes the axes into 64 bits; buckets that fall together only add candidates.
            code = (code * np.uint64(0x9E3779B97F4A7C15)) ^ (signed[:, choices[:, h]] + np.uint64(size))
        best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        out.append(np.take_along_axis(code, best, 1))
    return np.concatenate(out, axis=1).view(np.int64)


def _bucket_numbers(tables: int, hashes: int, probes: int):
    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                rows = pa.array(np.flatnonzero(lengths == length))
                found = probes_of(_matrix(lists.take(rows)), tables, hashes, probes)
                ends = pa.array(np.arange(0, found.size + 1, found.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], names=["class", "codes"]
                )

    return run


def _near(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of unit vectors reach the threshold; close calls by exactly rounded sums."""
    cosines = left @ right.T
    near = cosines >= threshold
    for i, j in zip(*np.nonzero(np.abs(cosines - threshold) < MARGIN)):
        x, y = left[i], right[j]
        norms = math.sqrt(math.fsum(x * x)) * math.sqrt(math.fsum(y * y))
        near[i, j] = math.fsum(x * y) / norms >= threshold
    return near


def _met_before(keys: list[np.ndarray], key: int, split: int) -> np.ndarray:
    """Which pairs of rows (the first ``split`` against the others) also share a bucket with a smaller number."""
    lower = [k[k < key] for k in keys]
    owner = np.repeat(np.arange(len(keys)), [len(k) for k in lower])
    _, code, count = np.unique(np.concatenate(lower), return_inverse=True, return_counts=True)
    shared = count[code] > 1
    used, code = np.unique(code[shared], return_inverse=True)
    member = np.zeros((len(keys), len(used)), dtype=np.float32)
    member[owner[shared], code] = 1
    return (member[:split] @ member[split:].T) > 0


def _roots(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row each row reaches over pairs (i, j)."""
    root = np.arange(rows)
    while True:
        least = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, least)
        np.minimum.at(after, j, least)
        after = np.minimum(after, after[after])
        if (after == root).all():
            return root
        root = after


class _Rows:
    """Rows of the comparing step as numpy arrays; unit vectors and bucket numbers lie one after the other."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        self.key, self.i, self.j, self.mine, self.classes, self.weights = (
            rows[c].to_numpy() for c in ("key", "i", "j", "mine", "class", "n")
        )
        self.groups = rows["grp"].combine_chunks().dictionary_encode().indices.to_numpy()
        lists = rows["vec"].combine_chunks()
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        lengths = lists.value_lengths().to_numpy()
        self.vec_at = np.concatenate([[0], np.cumsum(lengths)])
        values = values / np.repeat(np.maximum.reduceat(np.abs(values), self.vec_at[:-1]), lengths)
        self.values = values / np.repeat(np.sqrt(np.add.reduceat(values * values, self.vec_at[:-1])), lengths)
        keys = rows["keys"].combine_chunks()
        self.buckets = keys.flatten().to_numpy()
        self.key_at = np.concatenate([[0], np.cumsum(keys.value_lengths().to_numpy())])

    def starts(self) -> np.ndarray:
        changed = np.ones(len(self.key), dtype=bool)
        changed[1:] = (self.key[1:] != self.key[:-1]) | (self.i[1:] != self.i[:-1]) | (self.j[1:] != self.j[:-1])
        return np.flatnonzero(changed)

    def vectors(self, start: int, end: int) -> np.ndarray:
        lengths = np.diff(self.vec_at[start : end + 1])
        if (lengths != lengths[0]).any():
            raise ValueError("vectors of different lengths met in a bucket")
        return self.values[self.vec_at[start] : self.vec_at[end]].reshape(end - start, -1)


def _compare(threshold: float):
    """Rows sorted by bucket and pair of blocks become ``(class, links, root)``: how many rows the class links to
    here that it does not meet in a bucket before, and the smallest class it reaches here."""

    def unit(rows: _Rows, start: int, end: int):
        if end - start < 2:
            return None
        key, vectors = int(rows.key[start]), rows.vectors(start, end)
        mine, groups = rows.mine[start:end], rows.groups[start:end]
        same = rows.i[start] == rows.j[start]
        a = np.flatnonzero(mine == rows.i[start])
        b = a if same else np.flatnonzero(mine == rows.j[start])
        if not len(a) or not len(b):
            return None
        near = _near(vectors[a], vectors[b], threshold) & (groups[a][:, None] == groups[b][None, :])
        if same:
            near = np.triu(near, 1)
        if not near.any():
            return None
        # Only rows with a near partner go on.
        ra, rb = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        near = near[np.ix_(ra, rb)]
        a, b = a[ra], b[rb]
        own = [rows.buckets[rows.key_at[start + r] : rows.key_at[start + r + 1]] for r in np.concatenate([a, b])]
        fresh = near & ~_met_before(own, key, len(a))
        classes, weights = rows.classes[start:end], rows.weights[start:end]
        links = np.zeros(end - start, dtype=np.int64)
        links[a] += (fresh * weights[b][None, :]).sum(axis=1)
        links[b] += (fresh * weights[a][:, None]).sum(axis=0)
        some = np.unique(np.concatenate([a, b]))
        # Places in ascending order of the class, so that the least place is the least class.
        place = np.empty(end - start, dtype=np.int64)
        order = some[np.argsort(classes[some], kind="stable")]
        place[order] = np.arange(len(order))
        p, q = np.nonzero(near)
        root = _roots(len(order), place[a[p]], place[b[q]])
        return classes[order], links[order], classes[order][root]

    def done(rows: _Rows, starts: np.ndarray, ends: np.ndarray):
        found = [x for x in map(lambda s, e: unit(rows, int(s), int(e)), starts, ends) if x is not None]
        if found:
            columns = [pa.array(np.concatenate([f[k] for f in found])) for k in range(3)]
            yield pa.RecordBatch.from_arrays(columns, names=["class", "links", "root"])

    def run(batches):
        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows < BLOCK:
                continue
            rows = _Rows(held)
            starts = rows.starts()
            # The last unit may go on in the next batch.
            yield from done(rows, starts[:-1], starts[1:])
            held = held.slice(int(starts[-1]))
        if held is not None and held.num_rows:
            rows = _Rows(held)
            starts = rows.starts()
            yield from done(rows, starts, np.append(starts[1:], held.num_rows))

    return run


def _classes(vectors: DataFrame, id_col: str, vector_col: str, group_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows that can link, the others, and one row for each distinct (group, vector)."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vec"), F.col(f"`{group_col}`").alias("grp"))

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    usable = F.col("grp").isNotNull() & F.forall("vec", finite) & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    good = rows.filter("usable").drop("usable")
    distinct = good.groupBy("grp", "vec").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    return good, rows.filter(~F.col("usable")), distinct.withColumn("class", F.monotonically_increasing_id())


def near_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label",
    threshold: float = 0.98, tables: int = 4, probes: int = 4,
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every row: rows of one group and one length link where the cosine of
    their vectors in double precision is at least ``threshold``. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable, ``kept`` says whether that is the row's own.

    Equal vectors of a group are one class with a weight. A table joins so many hashes, growing with the logarithm of
    the largest group, that vectors far apart seldom meet; a class probes ``probes`` buckets a hash in each. Buckets
    with one member go, the others compare all their members in blocks, so nothing is capped and no pairs leave a task.
    A pair that meets in several buckets counts in the one with the smallest number. Pairs at cosine 0.98 in 64
    dimensions, the hardest that link, are missed once in a billion with three hashes and once in 300,000 with six.

    Vectors that are null, zero, or hold null or non-finite components, and those of a null group, link with nothing:
    0 links, their own id, kept. Null ids are never the smallest, unless a component has no other (then the component
    is null and its rows are kept). Rows with one id are rows of their own; repeated rows link with each other. Other
    columns are not carried. No rows give no rows.
    """
    if not 0.5 <= threshold <= 1:
        raise ValueError("the threshold lies between 0.5 and 1")
    good, others, distinct = _classes(vectors, id_col, vector_col, group_col)
    classes = materialise(distinct, "vector-classes")
    sizes = classes.groupBy("grp", F.size("vec").alias("length")).agg(F.count("*").alias("n"))
    widest = sizes.agg(F.max(F.ceil(F.log("n") / F.log(2.0 * F.col("length") + 2)))).first()[0]
    hashes = 1 + max(1, int(widest or 1))

    hashed = map_arrow(classes.select("class", "vec"), _bucket_numbers(tables, hashes, probes * hashes), "class long, codes array<long>")
    named = materialise(hashed, "codes").join(classes.select("class", "grp", F.size("vec").alias("length")), "class")
    spread = named.select("class", "grp", "length", F.explode(F.array_distinct("codes")).alias("code"))
    dealt = materialise(spread.select("class", F.xxhash64("grp", "length", "code").alias("key")).distinct(), "dealt")
    live = materialise(dealt.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1"), "live")
    met = materialise(dealt.join(live, "key"), "met")
    # At most tables * probes * hashes buckets a class.
    listed = met.groupBy("class").agg(F.collect_list(F.struct("key", "members")).alias("buckets"))
    rows = classes.join(listed, "class").select("class", "grp", "vec", "n", F.col("buckets.key").alias("keys"), F.explode("buckets").alias("bucket"))
    blocks = F.ceil(F.col("bucket.members") / BLOCK).cast("int")
    placed = rows.select(
        "class", "grp", "vec", "n", "keys", F.col("bucket.key").alias("key"), blocks.alias("blocks"),
        F.pmod(F.xxhash64("class", "bucket.key"), blocks).cast("int").alias("mine"),
    )
    units = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "class", "grp", "vec", "n", "keys"
    )
    arranged = units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = materialise(map_arrow(arranged, _compare(threshold), "class long, links long, root long"), "found")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    edges = found.filter(F.col("class") > F.col("root")).select(F.col("class").alias("a"), F.col("root").alias("b"))
    roots = stars(edges).select(F.col("a").alias("class"), F.col("b").alias("root"))

    rooted = materialise(
        classes.join(links, "class", "left").join(roots, "class", "left")
        .select("grp", "vec", "n", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "class").alias("root")),
        "rooted",
    )
    least = materialise(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    known = materialise(
        rooted.join(least, "root").select("grp", "vec", (F.col("n") - 1 + F.col("links")).cast("long").alias("n_links"), "component_id"),
        "vector-results",
    )
    release(dealt, live, met, found, rooted, least)
    linked = good.join(known, ["grp", "vec"]).select("id", "n_links", "component_id")
    alone = others.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
