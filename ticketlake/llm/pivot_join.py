"""Near-duplicate vectors by an exact range join in a metric space.

Two vectors link when their cosine is ``cosine`` or more. The angle between vectors is a
metric, so with eps = arccos(cosine) the triangle inequality holds what follows.

- Pivots: a bounded sample of the vectors. Every vector belongs to the cell of its nearest
  pivot, and there to the core (not further than eps / 2 from it) or to the shell. A
  part is one of the two, with the least and greatest angle of its members to the pivot.
- Boundary replication: a vector at angle d to a pivot is within eps of no member of a part
  if d - greatest > eps or least - d > eps, and of every member if d + greatest <= eps. In the
  first case nothing is done, in the second the whole part is linked at once, by its
  count and by one of its members: groups of near copies, however large, are not paired up.
  Otherwise, the vector is replicated to the part. Of two parts the one with the smaller number asks.
- Parts are packed into bins of bounded bytes, larger ones are cut into blocks, and the
  vectors that ask are cut alike. Each pair of blocks is compared by matrix products in a
  task of its own. It gives counts and the links of a spanning forest, at most one a vector, never the pairs.
- Equal vectors are one class from the start.

How much the bounds save depends on the data. Vectors with no nearness at all (all angles
around 90 degrees) are outside of no boundary, and then the join is the tiled comparison of all blocks.

Classes are known by a 64-bit hash that is checked against a second one, and salted anew if two vectors share it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ticketlake.llm.common import discard, mix, written
from ticketlake.llm.components import connected

#: Vectors a cell has on average, most pivots and bytes of one (longer vectors are no pivots), bytes of a block.
CELL_ROWS, PIVOTS, PIVOT_BYTES, BLOCK_BYTES = 512, 1024, 1 << 16, 4 << 20
#: Rounding of angles, far above their error; and rows of a product on either side.
_SLACK, _TILE = 1e-6, 2048

_RNG = np.random.default_rng(20240301)
_SALT = _RNG.integers(1, 2**63, 2, dtype=np.uint64)


# --- vectors -------------------------------------------------------------------------


def unit_vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """By length of the vectors: their rows and the vectors of length 1. Null, empty and zero ones and those with a null or non-finite place are left out."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.asarray(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    edges = np.concatenate(([0], np.cumsum(sizes)))
    out = []
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        x = values[edges[rows][:, None] + np.arange(size)]
        largest = np.abs(x).max(axis=1)
        fine = np.isfinite(x).all(axis=1) & (largest > 0)
        rows, x = rows[fine], x[fine] / largest[fine, None]
        out.append((rows, x / np.linalg.norm(x, axis=1, keepdims=True) + 0.0))
    return out


def _hashes(x: np.ndarray, salt: int) -> np.ndarray:
    bits = np.ascontiguousarray(x).view(np.uint64)
    places = np.arange(x.shape[1], dtype=np.uint64)
    return mix(mix(bits + mix(places + np.uint64(salt))).sum(axis=1, dtype=np.uint64) + np.uint64(x.shape[1]))


def _units(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            known, cls, check, units = np.zeros(n, bool), np.zeros(n, np.uint64), np.zeros(n, np.uint64), [None] * n
            for rows, x in unit_vectors(batch.column(1)):
                known[rows] = True
                cls[rows], check[rows] = _hashes(x, int(_SALT[0]) + seed), _hashes(x, int(_SALT[1]) + seed)
                for i, v in zip(rows.tolist(), x):
                    units[i] = v.tobytes()
            hashes = [pa.array(h.view(np.int64), mask=~known) for h in (cls, check)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *hashes, pa.array(units, pa.binary())], ["vec_id", "cls", "check", "unit"])

    return run


def by_length(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """By length of the vectors (as bytes): their rows and the vectors."""
    raw = column.to_pylist()
    sizes = np.array([len(x) for x in raw], np.int64)
    out = []
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        out.append((rows, np.frombuffer(b"".join(raw[i] for i in rows.tolist()), np.float64).reshape(len(rows), -1)))
    return out


class Pivots:
    """The pivots, and the angle of vectors to each; where lengths differ the shorter one goes on with zeros."""

    def __init__(self, vectors: list[bytes]):
        self.vectors = [np.frombuffer(v, np.float64) for v in vectors]

    def angles(self, x: np.ndarray) -> np.ndarray:
        size = x.shape[1]
        p = np.zeros((len(self.vectors), size))
        for i, v in enumerate(self.vectors):
            p[i, : min(size, len(v))] = v[:size]
        return np.arccos(np.clip(x @ p.T, -1.0, 1.0))


def _assign(pivots: Pivots, eps: float):
    """Classes -> with ``part`` (two for each pivot: core and shell) and ``angle`` to the pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, angle = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for rows, x in by_length(batch.column(3)):
                all_ = pivots.angles(x)
                near = all_.argmin(axis=1)
                angle[rows] = all_[np.arange(len(rows)), near]
                part[rows] = 2 * near + (angle[rows] > eps / 2 - _SLACK)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part), pa.array(angle)], ["cls", "n", "lowest", "unit", "part", "angle"])

    return run


class Parts:
    """What is known of all parts: members, angles, lengths, a member, and the bin each is in. At most two rows for each pivot."""

    def __init__(self, rows: list, pivots: int, eps: float, block_bytes: int):
        self.eps, count = eps, 2 * pivots
        self.total, self.leader = np.zeros(count, np.int64), np.zeros(count, np.int64)
        self.least, self.most, self.size, self.bin = np.full(count, np.inf), np.full(count, -np.inf), np.full(count, -1), np.full(count, -1)
        #: bin -> blocks of its members
        self.blocks: list[int] = []
        held = block_bytes + 1
        for r in sorted(rows, key=lambda r: r.part):
            self.total[r.part], self.leader[r.part], self.least[r.part], self.most[r.part] = r.total, r.leader, r.least, r.most
            self.size[r.part] = r.size if r.size == r.sizes else -1
            if held + r.bytes > block_bytes:
                self.blocks.append(0)
                held = 0
            held += r.bytes
            self.bin[r.part] = len(self.blocks) - 1
            self.blocks[-1] = -(-held // block_bytes)
        self.whole = (2 * self.most <= eps - _SLACK) & (self.size >= 0)

    def of_bin(self, number: int) -> np.ndarray:
        return np.flatnonzero(self.bin == number)

    def relations(self, angles: np.ndarray, part: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """For vectors (rows) and parts (columns): linked with all members; to be compared with the members."""
        d = np.repeat(angles, 2, axis=1)
        number = np.arange(d.shape[1])
        own, later = part[:, None] == number, part[:, None] < number
        near = (d - self.most <= self.eps + _SLACK) & (self.least - d <= self.eps + _SLACK)
        every = later & (d + self.most <= self.eps - _SLACK) & (self.size == size)
        every |= own & self.whole
        return every, (later & near | own) & ~every


_ROUTED = {"kind": pa.int32(), "cls": pa.int64(), "other": pa.int64(), "n": pa.int64(), "part": pa.int32(), "bin": pa.int32(), "wanted": pa.binary(), "unit": pa.binary()}
_ROUTED_SCHEMA = "kind int, cls long, other long, n long, part int, bin int, wanted binary, unit binary"
_ASK, _COUNT, _PART, _LINK = range(4)


def _routed(kind: int, rows: int, **columns) -> pa.RecordBatch:
    made = [pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in _ROUTED.items() if c != "kind"]
    return pa.RecordBatch.from_arrays([pa.array(np.full(rows, kind, np.int32)), *made], list(_ROUTED))


def _route(pivots: Pivots, parts: Parts):
    """Classes -> those that ask bins (and which parts of each), counts of classes and of parts linked as a whole, and links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, n, part = (batch.column(c).to_numpy() for c in ("cls", "n", "part"))
            given = np.zeros(len(parts.total), np.int64)
            for rows, x in by_length(batch.column("unit")):
                every, ask = parts.relations(pivots.angles(x), part[rows], x.shape[1])
                i, s = np.nonzero(every)
                own = part[rows[i]] == s
                mine = np.bincount(i, parts.total[s] - np.where(own, n[rows[i]], 0), len(rows)).astype(np.int64)
                np.add.at(given, s, np.where(own, 0, n[rows[i]]))
                gained = np.flatnonzero(mine)
                yield _routed(_COUNT, len(gained), cls=cls[rows[gained]], n=mine[gained])
                # a link to the first part, and the other parts are joined to that one
                first = np.full(len(rows), -1)
                first[i[::-1]] = s[::-1]
                some = np.flatnonzero(first >= 0)
                yield _routed(_LINK, len(some), cls=cls[rows[some]], other=parts.leader[first[some]])
                a, b = np.unique(np.stack((first[i], s)), axis=1)
                yield _routed(_LINK, len(a), cls=parts.leader[a], other=parts.leader[b])
                for number in range(len(parts.blocks)):
                    wanted = ask[:, parts.of_bin(number)]
                    asking = np.flatnonzero(wanted.any(axis=1))
                    if len(asking):
                        at = rows[asking]
                        masks = [x.tobytes() for x in np.packbits(wanted[asking], axis=1)]
                        units = batch.column("unit").take(pa.array(at))
                        yield _routed(_ASK, len(at), cls=cls[at], n=n[at], part=part[at], bin=np.full(len(at), number), wanted=masks, unit=units)
            filled = np.flatnonzero(given)
            yield _routed(_PART, len(filled), part=filled, n=given[filled])

    return run


# --- blocks --------------------------------------------------------------------------


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between numbers -> fewer links with the same components: every number with its smallest."""
    nodes, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low, new = np.minimum(label[x], label[y]), label.copy()
        for side in (x, y, label[x], label[y]):
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def compare(asks: pa.Table, members: pa.Table, bin_parts: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of both sides with the number of vectors linked to each, and links with the components of all that are linked."""
    a_cls, a_n, a_part = (asks.column(c).to_numpy() for c in ("cls", "n", "part"))
    m_cls, m_n, m_part = (members.column(c).to_numpy() for c in ("cls", "n", "part"))
    a_count, m_count = np.zeros(len(a_cls), np.int64), np.zeros(len(m_cls), np.int64)
    masks = np.frombuffer(b"".join(asks.column("wanted").to_pylist()), np.uint8).reshape(len(a_cls), -1)
    wanted = np.unpackbits(masks, axis=1)[:, : len(bin_parts)].astype(bool)
    place = np.searchsorted(bin_parts, m_part)
    links: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2]
    of_size = {x.shape[1]: (rows, x) for rows, x in by_length(members.column("unit"))}
    for rows, x in by_length(asks.column("unit")):
        others, y = of_size.get(x.shape[1], (np.zeros(0, np.int64), x[:0]))
        for i in range(0, len(rows), _TILE):
            for j in range(0, len(others), _TILE):
                p, q = np.nonzero(x[i : i + _TILE] @ y[j : j + _TILE].T >= cosine)
                p, q = rows[i + p], others[j + q]
                # within a part both ask each other; the smaller class counts
                fine = wanted[p, place[q]] & ((a_part[p] != m_part[q]) | (a_cls[p] < m_cls[q]))
                p, q = p[fine], q[fine]
                a_count += np.bincount(p, m_n[q], len(a_cls)).astype(np.int64)
                m_count += np.bincount(q, a_n[p], len(m_cls)).astype(np.int64)
                if len(p):
                    links.append(forest(a_cls[p], m_cls[q]))
    cls, count = np.concatenate((a_cls, m_cls)), np.concatenate((a_count, m_count))
    return cls[count > 0], count[count > 0], *forest(*(np.concatenate(v) for v in zip(*links)))


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Neighbouring rows with the same keys."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(c).to_numpy() for c in keys]
        new = np.zeros(batch.num_rows, bool)
        for v in values:
            new[1:] |= v[1:] != v[:-1]
        new[0] = last is not None and last != tuple(v[0] for v in values)
        edges = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            if new[a] and held:
                yield pa.Table.from_batches(held)
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
        last = tuple(v[-1] for v in values)
    if held:
        yield pa.Table.from_batches(held)


def _compare_blocks(parts: Parts, cosine: float):
    """Rows by pair of blocks -> counts of classes and links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ("bin", "j", "k")):
            asking = group.column("asks").to_numpy()
            asks, members = group.filter(pa.array(asking)), group.filter(pa.array(~asking))
            if len(asks) and len(members):
                cls, n, a, b = compare(asks, members, parts.of_bin(int(group.column("bin")[0].as_py())), cosine)
                yield _routed(_COUNT, len(cls), cls=cls, n=n).select(["kind", "cls", "other", "n"])
                yield _routed(_LINK, len(a), cls=a, other=b).select(["kind", "cls", "other", "n"])

    return run


# --- the steps -----------------------------------------------------------------------


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.9, vec_id: str = "vec_id", vector: str = "embedding",
    cell_rows: int = CELL_ROWS, pivots: int = PIVOTS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors of the same length link if their cosine is ``cosine`` (above 0) or more; places
    are read as doubles. ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id
    reachable by links, itself included, ``kept`` says whether that is the own one. Null, empty and zero vectors
    and those with a null or non-finite place link with nothing. Rows are vectors of
    their own: equal rows link, and rows that repeat a component's smallest id are all kept. A
    null id counts as larger than any other; where a component has no other it is null and such rows are
    kept. Without vectors the result is empty. Further columns are ignored. At most ``pivots``
    vectors and two rows of figures for each go through the driver.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    spark, eps = vectors.sparkSession, float(np.arccos(cosine))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    seed = 0
    while True:
        units = written(rows.mapInArrow(_units(seed), "vec_id long, cls long, check long, unit binary"), "units")
        known = units.where("cls is not null")
        clash = known.groupBy("cls").agg(F.min("check").alias("a"), F.max("check").alias("b"))
        if clash.where("a <> b").isEmpty():
            break
        seed += 1
    classes = known.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("lowest"), F.first("unit").alias("unit"))
    classes = written(classes, "classes")
    wanted = max(1, min(pivots, -(-classes.count() // cell_rows)))
    sample = classes.where(F.octet_length("unit") <= PIVOT_BYTES).orderBy(F.xxhash64("cls"), "cls").limit(wanted).select("unit").collect()
    chosen = Pivots([bytes(r.unit) for r in sample] or [np.ones(1).tobytes()])

    cells = written(classes.mapInArrow(_assign(chosen, eps), "cls long, n long, lowest long, unit binary, part int, angle double"), "cells")
    size = F.octet_length("unit").cast("long")
    figures = cells.groupBy("part").agg(
        F.sum("n").alias("total"), F.min("cls").alias("leader"), F.min("angle").alias("least"), F.max("angle").alias("most"),
        F.min(size / 8).cast("int").alias("size"), F.max(size / 8).cast("int").alias("sizes"), F.sum(size + 64).alias("bytes"),
    )
    parts = Parts(figures.collect(), len(chosen.vectors), eps, block_bytes)
    routed = written(cells.mapInArrow(_route(chosen, parts), _ROUTED_SCHEMA), "routed")

    # each bin's members and askers in blocks; bins are at most as many as parts
    asked = {r.bin: r.bytes for r in routed.where(F.col("kind") == _ASK).groupBy("bin").agg(F.sum(size + 64).alias("bytes")).collect()}
    shape = [(int(p), int(b), parts.blocks[b], -(-asked[b] // block_bytes)) for p, b in enumerate(parts.bin) if b in asked]
    shape = spark.createDataFrame(shape, "part int, bin int, n_j int, n_k int")
    members = cells.join(F.broadcast(shape), "part").withColumn("j", F.pmod(F.xxhash64("cls"), "n_j").cast("int"))
    members = members.withColumns({"asks": F.lit(False), "wanted": F.lit(None).cast("binary"), "k": F.explode(F.expr("sequence(0, n_k - 1)"))})
    asks = routed.where(F.col("kind") == _ASK).join(F.broadcast(shape.drop("part").distinct()), "bin").withColumn("k", F.pmod(F.xxhash64("cls", F.lit(1)), "n_k").cast("int"))
    asks = asks.withColumns({"asks": F.lit(True), "j": F.explode(F.expr("sequence(0, n_j - 1)"))})
    names = ["bin", "j", "k", "asks", "cls", "n", "part", "wanted", "unit"]
    dealt = members.select(*names).unionByName(asks.select(*names)).repartition("bin", "j", "k").sortWithinPartitions("bin", "j", "k")
    compared = written(dealt.mapInArrow(_compare_blocks(parts, cosine), "kind int, cls long, other long, n long"), "compared")

    found = routed.select("kind", "cls", "other", "n").unionByName(compared)
    given = written(routed.where(F.col("kind") == _PART).groupBy("part").agg(F.sum("n").alias("n")), "given")
    counts = found.where(F.col("kind") == _COUNT).select("cls", "n").unionByName(cells.select("part", "cls").join(given, "part").select("cls", "n"))
    counts = written(counts.groupBy("cls").agg(F.sum("n").alias("more")), "counts")
    groups = written(connected(found.where(F.col("kind") == _LINK).select(F.col("cls").alias("a"), F.col("other").alias("b"))), "groups")
    each = cells.select("cls", "n", "lowest").join(counts, "cls", "left").join(groups.withColumnRenamed("node", "cls"), "cls", "left")
    each = written(each.select("cls", "lowest", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("component", "cls").alias("component")), "each")
    lowest = written(each.groupBy("component").agg(F.min("lowest").alias("component_id")), "lowest")
    each = written(each.drop("lowest").join(lowest, "component").select("cls", "n_links", "component_id"), "of-class")
    discard(classes, cells, routed, compared, given, counts, groups)
    result = units.select("vec_id", "cls").join(each, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select(
        F.col("vec_id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )


def oracle() -> str:
    return """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
r(node, seen) AS (SELECT a, b FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a),
m AS (SELECT node AS vec_id, min(seen) AS m FROM r GROUP BY node)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN m USING (vec_id)"""
