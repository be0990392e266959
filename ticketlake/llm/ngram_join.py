"""Near-duplicate documents by a parity-sketch join of their word n-grams.

A document is the set of its distinct shingles. XOR-ing hashed shingles into a bit sketch
keeps the parity of each bit, so the number of bits in which two sketches differ is never
more than the number of shingles that only one document has. A Jaccard similarity of
p / 100 and sizes a, b leave at most (100 - p) (a + b) / (100 + p) such shingles.

- Size bands: sizes grow by 100 / p from band to band, and linked documents are in the
  same or in neighbouring bands. A domain is two neighbouring bands; every document is in two.
- Pigeonhole: in a domain whose largest sizes allow t differing shingles, shingles are
  dealt by hash to t + 1 + e parts. Linked documents agree in at least 1 + e parts' parity
  sketches, whose linear (XOR) hashes are the join keys. A document with at most e empty
  parts leaves those out: one of the others agrees as well. (Two documents that both have
  more empty parts both keep them.) So parts that say nothing rarely become keys.
  Where pairs are listed, they must share as many keys as the parts left out allow for.
- Buckets are not paired up. Each bucket's first document is compared with the others
  (a star), by parity sketches of the whole documents and then by their texts, and what
  is linked becomes components. Only where a bucket still holds more than one component are members of different components
  compared, by sketches and then by texts. So every link between components is found,
  and no group emits all its pairs. A large bucket is dealt to blocks of bounded bytes, and
  only its members outside its largest component go to all of them. There each first meets
  the nearest member of another component only, in a few of its keys; what is linked then is one
  component, and all pairs that are still allowed between components are compared after that.

Sets are known by a 64-bit hash, which is checked against a second one; if two different
sets collide the hash is salted anew.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import AtomicType

from ticketlake.llm.common import column_bytes, discard, gram_hashes, lower_ascii, meeting, mix, release, runs_of, word_hashes, word_spans, written
from ticketlake.llm.components import connected

_RUN = 1 << 20
#: Rows with two texts or sketches that go to Python at once.
WIDE = 250
#: Members of a bucket whose pairs are listed before their sketches are looked at.
FEW = 64
#: Large buckets in which a class looks for its nearest, before all that is left is compared.
ASKED = 8
#: Bytes of sketches in one block of a larger bucket (a row counts as 1 KB at least), and rows and bytes that a task holds before it compares.
BLOCK_BYTES = 4 << 20
_HELD_ROWS, _HELD_BYTES = 5_000, 8 << 20
#: Rows of shared buckets for one task of the steps after them, and tasks at least; few rows are not dealt to as many tasks as texts.
TASK_ROWS, LEAST_TASKS = 20_000, 12
#: Keys that a task puts in order at most, about: what it sorts in does not grow with the corpus, however few partitions shuffles have.
SORTED_KEYS = 400_000
#: A row's sides in a comparison: it is compared with the others, they are compared with it, it is outside the bucket's largest component.
_ASKS, _ANSWERS, _OUTSIDE = 1, 2, 4


def shingle_sets(data: np.ndarray, bounds: np.ndarray, shingle: int, seed: int = 0) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer words the whole sequence is one."""
    starts, ends, firsts = word_spans(data, bounds)
    if not len(starts):
        return [np.zeros(0, np.uint64)] * (len(bounds) - 1)
    words = mix(word_hashes(lower_ascii(data), starts, ends) + np.uint64(seed))
    grams = gram_hashes(words, shingle)
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= shingle:
            out.append(np.unique(grams[a : b - shingle + 1]))
        elif b > a:
            # its length is part of it, so that it meets no longer text's shingle
            out.append(gram_hashes(words[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _each(batch: pa.RecordBatch, shingle: int, seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and set of each text, column 1 of the batch."""
    data, bounds = column_bytes(batch.column(1))
    for first, last in runs_of(bounds, _RUN):
        sets = shingle_sets(data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], shingle, seed)
        yield from zip(range(first, last), sets)


class Bands:
    """Which sizes may be linked, and how many differing shingles they allow."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("percent must be from 50 to 100")
        self.percent, self.starts = percent, [1]

    def start(self, band: int) -> int:
        while len(self.starts) <= band:
            last = self.starts[-1]
            # the first size that the previous band's first size cannot be linked with
            self.starts.append(last * 100 // self.percent + 1)
        return self.starts[band]

    def band(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.start(len(self.starts))
        return bisect_right(self.starts, size) - 1

    def largest(self, domain: int) -> int:
        return self.start(domain + 2) - 1

    def differing(self, a, b):
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def spare(self, domain: int) -> int:
        """Parts beyond those that the pigeonhole needs."""
        return 1 + self.differing(self.largest(domain), self.largest(domain)) // 25

    def parts(self, domain: int) -> int:
        return self.differing(self.largest(domain), self.largest(domain)) + 1 + self.spare(domain)

    def bits(self, domain: int) -> int:
        """Bits of a whole document's sketch in a domain: eight for each shingle, in eight slices of whole words."""
        return -(-8 * self.largest(domain) // 512) * 512

    def domains(self, size: int) -> list[int]:
        """The domain that a document's band opens, and the one that it closes."""
        band = self.band(size)
        return [band, band - 1] if band else [0]


def sketch(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the shingles of each bit."""
    spread = mix(shingles + np.uint64(0x51ED270B0A1F39C1))
    parity = np.bincount((spread % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little")


def folded(drawn: bytes) -> bytes:
    """A sketch of an eighth of the bits: the parity of each bit's eight places."""
    return np.bitwise_xor.reduce(np.frombuffer(drawn, np.uint8).reshape(8, -1), axis=0).tobytes()


def _dealt(shingles: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each shingle, and its part."""
    spread = mix(shingles ^ np.uint64(0x9FB21C651E98DF25))
    return spread, (spread % np.uint64(parts)).astype(np.int64)


def keys_shared(shingles: np.ndarray, parts: int, spare: int) -> int:
    """How many keys a document shares at least with one that it is linked with and that leaves out no more parts."""
    empty = parts - np.count_nonzero(np.bincount(_dealt(shingles, parts)[1], minlength=parts))
    return 1 + spare - (int(empty) if empty <= spare else 0)


def part_keys(shingles: np.ndarray, domain: int, parts: int, spare: int) -> np.ndarray:
    """Join key of each part: the XOR hash of its parity sketch, with domain and part; up to ``spare`` empty parts are left out."""
    spread, part = _dealt(shingles, parts)
    order = np.argsort(part, kind="stable")
    sums = np.concatenate((np.zeros(1, np.uint64), np.bitwise_xor.accumulate(mix(spread)[order])))
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    parity = sums[edges[1:]] ^ sums[edges[:-1]]
    keys = mix(parity + mix(np.uint64(domain << 32) + np.arange(parts, dtype=np.uint64)))
    filled = edges[1:] > edges[:-1]
    return keys[filled] if parts - filled.sum() <= spare else keys


# --- the steps ---------------------------------------------------------------------


def _dealt_keys(signs: DataFrame, sets: DataFrame, bands: Bands, most: int | None = None) -> DataFrame:
    """Join keys dealt by key, to more tasks than shuffles have where these would get more than ``most`` keys each."""
    # sizes grow from band to band, so there are few bands
    counts = sets.where("n > 0").groupBy("domain").count().collect()
    keys = sum(n * sum(bands.parts(x) for x in {d, max(d - 1, 0)}) for d, n in counts)
    tasks = -(-keys // (most or SORTED_KEYS))
    return signs.repartition(tasks, "k") if tasks > int(signs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else signs.repartition("k")


def _class_of(s: np.ndarray) -> int:
    return int(mix(np.bitwise_xor.reduce(mix(s), keepdims=True) + np.uint64(len(s))).view(np.int64)[0])


_SETS = "key long, doc_id long, n long, cls long, check long, domain int, own binary, below binary, own_small binary, below_small binary, own_shared int, below_shared int"


def _sets(shingle: int, seed: int, bands: Bands):
    """Of each row: its size, two hashes of the set, the domain its band opens, and its sketches and least shared keys in that and the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for _, s in _each(batch, shingle, seed):
                if not len(s):
                    out.append((0, 0, 0, 0, *[None] * 6))
                    continue
                check = int(mix(np.add.reduce(mix(s ^ np.uint64(0xA5A5)), keepdims=True) + np.uint64(len(s))).view(np.int64)[0])
                drawn = [sketch(s, bands.bits(d)).tobytes() for d in bands.domains(len(s))]
                drawn = [*drawn, None][:2]
                small = [x if x is None else folded(x) for x in drawn]
                shared = [keys_shared(s, bands.parts(d), bands.spare(d)) for d in bands.domains(len(s))]
                out.append((len(s), _class_of(s), check, bands.band(len(s)), *drawn, *small, *[*shared, None][:2]))
            columns = zip(*out) if out else [[]] * 10
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4, *[pa.int32()] * 2)
            rest = [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *rest], [x.split()[0] for x in _SETS.split(", ")])

    return run


def _signatures(shingle: int, seed: int, bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[np.ndarray] = []
            owners: list[tuple[int, int, int]] = []
            held = 0
            for _, s in _each(batch, shingle, seed):
                if not len(s):
                    continue
                cls = _class_of(s)
                for domain in bands.domains(len(s)):
                    got = part_keys(s, domain, bands.parts(domain), bands.spare(domain))
                    keys.append(got)
                    owners.append((cls, domain, len(got)))
                    held += len(got)
                if held > 100_000:
                    yield _signature_batch(keys, owners)
                    keys, owners, held = [], [], 0
            if keys:
                yield _signature_batch(keys, owners)

    return run


def _signature_batch(keys: list[np.ndarray], owners: list[tuple[int, int, int]]) -> pa.RecordBatch:
    cls, domain, n = (np.array(x, np.int64) for x in zip(*owners))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(cls, n)), pa.array(np.repeat(domain, n).astype(np.int32))], ["k", "cls", "domain"]
    )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ordered by key and class, the distinct ones of keys with two classes, with the key's first class."""
    rest: pa.RecordBatch | None = None
    carry: tuple[int, int, int, bool] | None = None  # key, first class, last class, whether the first row was written
    for batch in batches:
        if not batch.num_rows:
            continue
        k, cls, domain = (batch.column(i).to_numpy() for i in range(3))
        if carry is not None and carry[0] == k[0]:
            k, cls, domain = np.append(carry[0], k), np.append(carry[2], cls), np.append(domain[0], domain)
            lead, written_ = carry[1], carry[3]
        else:
            lead, written_ = None, False
        new = np.concatenate(([True], (k[1:] != k[:-1]) | (cls[1:] != cls[:-1])))
        k, cls, domain = k[new], cls[new], domain[new]
        begins = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        sizes = np.diff(np.append(begins, len(k)))
        first = np.repeat(cls[begins], sizes)
        if lead is not None:
            first[: sizes[0]] = lead
        emit = np.repeat(sizes > 1, sizes)
        if lead is not None and written_:
            emit[0] = False  # this row went out with the batch before
        out = [pa.array(x[emit]) for x in (k, cls, domain, first)]
        carry = (int(k[-1]), int(first[-1]), int(cls[-1]), bool(sizes[-1] > 1 or (len(sizes) == 1 and written_)))
        yield pa.RecordBatch.from_arrays(out, ["k", "cls", "domain", "lead"])


def _allowed(bands: Bands):
    """Pairs with sizes and sketches -> the pairs whose sizes and sketches let them be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, domain, n, m = (batch.column(i).to_numpy() for i in range(5))
            (left, bounds), (right, _) = column_bytes(batch.column(5)), column_bytes(batch.column(6))
            far = np.zeros(len(a), np.int64)
            for i, j in runs_of(bounds, _RUN):
                some = slice(bounds[i], bounds[j])
                sums = np.concatenate(([0], np.cumsum(np.bitwise_count(left[some] ^ right[some]), dtype=np.int64)))
                far[i:j] = np.diff(sums[bounds[i : j + 1] - bounds[i]])
            fine = (100 * np.minimum(n, m) >= bands.percent * np.maximum(n, m)) & (far <= bands.differing(n, m))
            yield pa.RecordBatch.from_arrays([pa.array(x[fine]) for x in (a, b, domain)], ["a", "b", "domain"])

    return run


def _verify(shingle: int, percent: int):
    """Pairs with their texts -> the pairs that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            text_a, (data, bounds) = batch.column("text_a"), column_bytes(batch.column("text_b"))
            linked = np.zeros(len(a), bool)
            for first, last in runs_of(bounds, _RUN):
                right = shingle_sets(data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], shingle)
                for i in range(first, last):
                    if known[0] != a[i]:
                        raw, limits = column_bytes(text_a.slice(i, 1))
                        known = (int(a[i]), shingle_sets(raw, limits, shingle)[0])
                    x, y = known[1], right[i - first]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    linked[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[linked]), pa.array(b[linked])], ["a", "b"])

    return run


def _blocks(members: DataFrame, block_bytes: int) -> DataFrame:
    """Members of mixed keys (``k``, ``cls``, ``label``, ``sketch`` and more) dealt to pairs of blocks of bounded size.

    ``members`` counts the rows of the key, ``top`` is its largest component and ``topped``
    the rows of that. Only rows outside it are compared with all rows, so only they go to
    every block; the block of a row is drawn by its class. ``side`` says what a row does in a
    pair of blocks. A key with one block has each row once.
    """
    size = F.greatest(F.length("sketch").cast("long"), F.lit(1024))
    asking = F.ceil((F.col("members") - F.col("topped")) * size / block_bytes).cast("int")
    answering = F.ceil(F.col("members") * size / block_bytes).cast("int")
    outside = F.col("label") != F.col("top")
    rest = [F.col(c) for c in members.columns if c not in ("members", "top", "topped")]
    rows = members.withColumns({"_asking": asking, "_answering": answering, "_outside": outside, "_drawn": F.xxhash64("cls", "k")})
    place = F.when(F.col("_answering") == 1, F.array(F.struct(F.lit(0).alias("p"), F.lit(0).alias("q"), F.when(F.col("_outside"), _ASKS | _ANSWERS | _OUTSIDE).otherwise(_ANSWERS).alias("side"))))
    mine_p, mine_q = (F.pmod("_drawn", c).cast("int") for c in ("_asking", "_answering"))
    answers = F.transform(
        F.sequence(F.lit(0), F.col("_asking") - 1),
        lambda p: F.struct(p.alias("p"), mine_q.alias("q"), F.when(F.col("_outside"), _ANSWERS | _OUTSIDE).otherwise(_ANSWERS).alias("side")),
    )
    asks = F.transform(F.sequence(F.lit(0), F.col("_answering") - 1), lambda q: F.struct(mine_p.alias("p"), q.alias("q"), F.lit(_ASKS | _OUTSIDE).alias("side")))
    place = place.when(F.col("_outside"), F.concat(answers, asks)).otherwise(answers)
    return rows.select(*rest, F.explode(place).alias("_place")).select(*rest, "_place.p", "_place.q", "_place.side")


def _between(bands: Bands, nearest: bool, marks: bool = False, cells: int = 1 << 21):
    """Rows of mixed keys, ordered by key and pair of blocks -> pairs of classes in different components that the sketches allow.

    With ``nearest`` each asking row gives one pair only, with the row that its sketch is nearest to. With
    ``marks`` only the rows (key, class) are given that are in some pair.
    """

    def pairs(rows: dict[str, np.ndarray], bits: np.ndarray, domain: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        cls, label, n, side, opens, asks = rows["cls"], rows["label"], rows["n"], rows["side"], rows["opens"] == domain, rows["asks"]
        bits = bits.view(np.uint64).reshape(len(cls), -1)
        asking, answering = np.flatnonzero(side & _ASKS), np.flatnonzero(side & _ANSWERS)
        high_step = max(1, min(256, cells // bits.shape[1]))
        wide = max(1, cells // (bits.shape[1] * min(max(1, len(answering)), high_step)))
        for i in range(0, len(asking), wide):
            left = asking[i : i + wide]
            best, mate = np.full(len(left), np.iinfo(np.int64).max), np.full(len(left), -1)
            for j in range(0, len(answering), high_step):
                right = answering[j : j + high_step]
                low, high = np.minimum(n[left][:, None], n[right][None, :]), np.maximum(n[left][:, None], n[right][None, :])
                fine = (label[left][:, None] != label[right][None, :]) & (100 * low >= bands.percent * high) & asks[left][:, None]
                # two documents of the domain's second band meet in the next domain
                fine &= opens[left][:, None] | opens[right][None, :]
                # two outside the largest component are asked from both sides
                fine &= ((side[right] & _OUTSIDE) == 0)[None, :] | (cls[left][:, None] < cls[right][None, :])
                if nearest:  # each asks for itself, so neither side is left out
                    fine = (label[left][:, None] != label[right][None, :]) & (100 * low >= bands.percent * high) & asks[left][:, None] & (opens[left][:, None] | opens[right][None, :])
                if not fine.any():
                    continue
                far = np.bitwise_count(bits[left][:, None, :] ^ bits[right][None, :, :]).sum(axis=2, dtype=np.int64)
                fine &= far <= bands.differing(low, high)
                if nearest:
                    far[~fine] = np.iinfo(np.int64).max
                    at = far.argmin(axis=1)
                    least = far[np.arange(len(left)), at]
                    better = least < best
                    best[better], mate[better] = least[better], right[at[better]]
                    continue
                x, y = np.nonzero(fine)
                if len(x):
                    yield cls[left[x]], cls[right[y]]
            if (mate >= 0).any():
                yield cls[left[mate >= 0]], cls[mate[mate >= 0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = pa.Table.from_batches(held)
            edges = np.append(_changes(block), block.num_rows)
            columns = {c: block.column(c).to_numpy() for c in ("cls", "label", "n", "opens", "side", "asks")}
            k, domain = block.column("k").to_numpy(), block.column("domain").to_numpy()
            data, bounds = column_bytes(block.column("sketch"))
            found: list[np.ndarray] = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                for x, y in pairs({c: v[a:b] for c, v in columns.items()}, data[bounds[a] : bounds[b]], int(domain[a])):
                    if marks:
                        some = np.unique(np.concatenate((x, y)))
                        found.append(np.stack((np.full(len(some), k[a]), some)))
                        continue
                    found.append(np.stack((np.minimum(x, y), np.maximum(x, y), np.full(len(x), domain[a]))))
            if found and marks:
                keys, cls = (np.ascontiguousarray(v) for v in np.unique(np.concatenate(found, axis=1), axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(cls)], ["k", "cls"])
            elif found:
                x, y, domains = (np.ascontiguousarray(v) for v in np.unique(np.concatenate(found, axis=1), axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(domains.astype(np.int32))], ["a", "b", "domain"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cut = 0
            if sum(x.num_rows for x in held) + batch.num_rows > _HELD_ROWS or sum(x.nbytes for x in held) + batch.nbytes > _HELD_BYTES:
                change = _changes(batch)
                if not held or all(held[-1].column(c)[-1].as_py() == batch.column(c)[0].as_py() for c in ("k", "p", "q")):
                    change = change[1:]
                if len(change):
                    cut = int(change[-1])
                    yield from solved([*held, batch.slice(0, cut)] if cut else held)
                    held = []
            held.append(batch.slice(cut))
        if held:
            yield from solved(held)

    return run


def _changes(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Rows at which a key or pair of blocks begins."""
    new = np.ones(rows.num_rows, bool)
    new[1:] = False
    for c in ("k", "p", "q"):
        v = rows.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


DRAWN = ["own", "below", "own_small", "below_small", "own_shared", "below_shared"]


def _own(size: str = "") -> Column:
    """A document's sketch (or what ``size`` names) in the row's domain."""
    return F.when(F.col("domain") == F.col("opens"), F.col(f"own{size}")).otherwise(F.col(f"below{size}"))


def _sketched(pairs: DataFrame, drawn: DataFrame, bands: Bands, tasks: int, sizes: tuple[str, ...] = ("_small", "")) -> DataFrame:
    """Of pairs ``a``, ``b`` of a ``domain`` those whose sketches let them be linked: small ones first, then whole ones."""
    spark = drawn.sparkSession
    for size in sizes:
        # the sketches that are asked for, so that all of them move once at most, and none where few are asked for
        asked = written(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "asked", tasks=tasks)
        some = written(meeting(drawn.select("cls", "n", "opens", f"own{size}", f"below{size}"), asked, "left_semi"), "asked-sketches")
        both = pairs
        for x in "ab":
            one = some.withColumnsRenamed({"cls": x, "n": f"n_{x}"})
            both = both.join(one, x).withColumn(f"s_{x}", _own(size)).drop("opens", f"own{size}", f"below{size}")
        both = both.select("a", "b", "domain", "n_a", "n_b", "s_a", "s_b").coalesce(tasks).mapInArrow(_allowed(bands), "a long, b long, domain int")
        before, pairs = pairs, written(both, "sketched", WIDE)
        discard(asked, some)
        if size != sizes[0]:
            discard(before)
        del both
        release(spark)
    return pairs


def _open_keys(members: DataFrame, drawn: DataFrame, tasks: int, size: str = "_small") -> DataFrame:
    """Rows ``k``, ``cls``, ``domain``, ``label``, ``asks`` of mixed keys with their sketches, dealt to blocks in order."""
    tops = members.groupBy("k", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("k").agg(F.sum("c").alias("members"), F.max(F.struct("c", "label")).alias("t"))
    tops = written(tops.select("k", "members", F.col("t.label").alias("top"), F.col("t.c").alias("topped")).where("topped < members"), "tops", tasks=tasks)
    some = drawn.select("cls", "n", "opens", f"own{size}", f"below{size}")
    rows = members.join(tops, "k").join(some, "cls")
    rows = rows.select("k", "cls", "domain", "label", "asks", "n", "opens", _own(size).alias("sketch"), "members", "top", "topped")
    return _blocks(rows, BLOCK_BYTES).repartition("k", "p", "q").sortWithinPartitions("k", "p", "q").coalesce(tasks)


def _links(rows: DataFrame, people: DataFrame, pairs: DataFrame, shingle: int, percent: int, tasks: int) -> DataFrame:
    """Of pairs of classes those whose sets are similar enough, by their texts."""
    a, b = (people.select(F.col("cls").alias(x), F.col("key").alias(f"key_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    sized = pairs.join(a, "a").join(b, "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    sized = written(sized.select("a", "b", "key_a", "key_b"), "pairs", tasks=tasks)
    # one text for each key that is asked for; equal rows share a key
    asked = written(sized.select(F.explode(F.array("key_a", "key_b")).alias("key")).distinct(), "asked-texts", tasks=tasks)
    texts = written(meeting(rows, asked, "left_semi").groupBy("key").agg(F.first("text").alias("text")), "texts", tasks=tasks)
    right, left = (texts.select(F.col("key").alias(f"key_{x}"), F.col("text").alias(f"text_{x}")) for x in "ba")
    full = sized.join(right, "key_b").join(left, "key_a").select("a", "b", "text_a", "text_b")
    linked = written(full.coalesce(tasks).mapInArrow(_verify(shingle, percent), "a long, b long"), "similar", WIDE)
    discard(sized, asked, texts)
    return linked


def _row(doc_id: str, text: str) -> tuple[Column, Column, Column]:
    """A row's key (hash of id and text), text and id."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    number = F.col(f"`{doc_id}`").cast("long")
    return F.xxhash64(number, body), body, number


def components(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``n_links``.

    Words are runs of other characters than blanks and controls 9 to 13, A-Z in lower
    case; with fewer than ``shingle`` words the whole sequence is one shingle. Documents
    link when 100 * shared >= percent * all shingles of the two. ``component_id`` is the
    smallest id reachable by links; a document with null, empty or blank text is linked
    with nothing and its own component. ``n_links`` counts the other sets that the search
    linked this one's with directly. Rows are documents of their own, so equal rows link;
    a null id counts as larger than any other. Without documents the result is empty.
    Further columns are ignored.
    """
    found = _grouped(docs, shingle, percent, doc_id, text)
    lowest = written(found.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("lowest")), "lowest")
    return found.join(lowest, "component", "left").select(
        F.col("doc_id").alias(doc_id), "n_shingles", F.coalesce("lowest", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _grouped(docs: DataFrame, shingle: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """One row per document: ``key``, ``doc_id``, ``n_shingles``, ``component`` (null without words) and ``n_links``."""
    spark = docs.sparkSession
    bands = Bands(percent)
    key, body, number = _row(doc_id, text)
    rows = docs.select(key.alias("key"), body.alias("text"), number.alias("doc_id"))
    seed = 0
    while True:
        sets = written(rows.mapInArrow(_sets(shingle, seed, bands), _SETS), "sets")
        clash = sets.where("n > 0").groupBy("cls").agg(F.min("check").alias("a"), F.max("check").alias("b"), F.min("n").alias("m"), F.max("n").alias("x"))
        if clash.where("a <> b or m <> x").isEmpty():
            break
        seed += 1
    # of each class of equal sets one row, whose text stands for all
    people = written(sets.where("n > 0").groupBy("cls").agg(F.min("key").alias("key"), F.first("n").alias("n")), "classes")

    signs = rows.mapInArrow(_signatures(shingle, seed, bands), "k long, cls long, domain int")
    signs = _dealt_keys(signs, sets, bands).sortWithinPartitions("k", "cls")
    buckets = written(signs.mapInArrow(_shared, "k long, cls long, domain int, lead long"), "buckets")
    del signs
    release(spark)
    # what follows has about as many rows as there are in shared buckets
    tasks = max(LEAST_TASKS, -(-buckets.count() // TASK_ROWS))

    # sketches of the classes that share a bucket with another one
    drawn = sets.select("cls", "key", "n", *DRAWN, F.col("domain").alias("opens"))
    sharing = written(people.select("key", "cls").join(buckets.select("cls").distinct(), "cls", "left_semi"), "sharing", tasks=tasks)
    drawn = written(meeting(drawn, sharing, "left_semi").drop("key"), "sketches", tasks=tasks)
    if drawn.count() > sharing.count():  # equal rows share a key; without them nothing has to be shuffled
        twice, drawn = drawn, written(drawn.dropDuplicates(["cls"]), "sketches", tasks=tasks)
        discard(twice)
    discard(sharing)
    fat, sets = sets, written(sets.select("key", "doc_id", "n", "cls"), "sizes")
    discard(fat)
    release(spark)
    stars = buckets.where("cls <> lead").groupBy(F.col("lead").alias("a"), F.col("cls").alias("b")).agg(F.min("domain").alias("domain"))
    stars = _sketched(stars, drawn, bands, tasks).select("a", "b")
    near = _links(rows, people, stars, shingle, percent, tasks)
    release(spark)
    labels = connected(near, tasks)

    # keys that still hold several components
    marked = buckets.select("k", "cls", "domain").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    marked = written(marked.select("k", "cls", "domain", F.coalesce("component", "cls").alias("label")), "marked", tasks=tasks)
    mixed = marked.groupBy("k").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("members")).where("low <> high")
    mixed = written(mixed.select("k", (F.col("members") > FEW).alias("many")), "mixed", tasks=tasks)
    release(spark)
    # small buckets: the same two documents may meet in very many of them, so their pairs come first and their sketches once
    sized = drawn.select("cls", "n", "opens", "own_shared", "below_shared")
    few = marked.join(mixed.where("not many"), "k").join(sized, "cls").withColumn("shared", _own("_shared")).drop("many", "own_shared", "below_shared")
    left, right = (few.select([F.col(c).alias(c if c == "k" else f"{c}_{x}") for c in few.columns]) for x in "ab")
    low, high = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    apart = (F.col("cls_a") < F.col("cls_b")) & (F.col("label_a") != F.col("label_b")) & (100 * low >= percent * high)
    # two documents of a domain's second band meet in the next domain
    apart &= (F.col("opens_a") == F.col("domain_a")) | (F.col("opens_b") == F.col("domain_a"))
    close = left.join(right, "k").where(apart).groupBy(F.col("cls_a").alias("a"), F.col("cls_b").alias("b"))
    # linked documents share several keys; those that miss some of them here share a large bucket, and are compared there
    close = close.agg(F.min("domain_a").alias("domain"), F.count(F.lit(1)).alias("met"), F.min(F.least("shared_a", "shared_b")).alias("shared"))
    close = written(close.where("met >= shared").drop("met", "shared"), "close", tasks=tasks)
    release(spark)
    close = _sketched(close, drawn, bands, tasks, ("_small",))
    # large buckets, first: in the largest ones of its keys each class meets the nearest of another component, by
    # small sketches; so groups of near copies that stars have left in parts grow together, at a few rows a class
    many = written(marked.join(mixed.where("many").select("k"), "k").select("k", "cls", "domain", "label"), "many", tasks=tasks)
    discard(marked, mixed)
    sizes = written(many.groupBy("k").agg(F.count(F.lit(1)).alias("members")), "key-sizes", tasks=tasks)
    largest = F.row_number().over(Window.partitionBy("cls").orderBy(F.desc("members"), "k"))
    asked = many.select("k", "cls").join(sizes, "k").withColumn("nth", largest).where(F.col("nth") <= ASKED)
    asked = written(asked.select("cls", "k"), "asked", tasks=tasks)
    some = many.join(asked.select("k").distinct(), "k", "left_semi").join(asked.withColumn("asks", F.lit(True)), ["cls", "k"], "left")
    met = _open_keys(some.withColumn("asks", F.coalesce("asks", F.lit(False))), drawn, tasks).mapInArrow(_between(bands, True), "a long, b long, domain int")
    met = written(met.groupBy("a", "b").agg(F.min("domain").alias("domain")), "nearest", WIDE, tasks)
    discard(sizes, asked)
    release(spark)
    tried = _sketched(met.unionByName(close).groupBy("a", "b").agg(F.min("domain").alias("domain")), drawn, bands, tasks, ("",))
    tried = written(tried.select("a", "b").join(stars, ["a", "b"], "left_anti"), "tried", tasks=tasks)
    links = near.unionByName(_links(rows, people, tried, shingle, percent, tasks))
    # then, in all that still hold several components, the members that small sketches let be linked with one of another
    # component, and of these every pair that whole sketches allow
    labels = written(connected(links, tasks), "labels", tasks=tasks)
    left_ = many.select("k", "cls", "domain").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    left_ = written(left_.select("k", "cls", "domain", F.coalesce("component", "cls").alias("label"), F.lit(True).alias("asks")), "left", tasks=tasks)
    marked = written(_open_keys(left_, drawn, tasks).mapInArrow(_between(bands, False, marks=True), "k long, cls long").distinct(), "marked", WIDE, tasks)
    few_left = written(left_.join(marked, ["k", "cls"], "left_semi"), "few-left", tasks=tasks)
    late = _open_keys(few_left, drawn, tasks, "").mapInArrow(_between(bands, False), "a long, b long, domain int").select("a", "b")
    late = written(late.distinct(), "between", WIDE, tasks)
    discard(buckets, many, met, left_, few_left, labels, marked)
    release(spark)
    late_pairs = late.join(stars, ["a", "b"], "left_anti").join(tried, ["a", "b"], "left_anti")
    links = links.unionByName(_links(rows, people, late_pairs, shingle, percent, tasks))
    discard(people, drawn, tried)
    release(spark)
    groups = written(connected(links, tasks), "groups", tasks=tasks)

    # classes to documents: a component's smallest id, over all its copies
    counts = links.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count(F.lit(1)).alias("n_links"))
    found = sets.select("key", "doc_id", F.col("n").alias("n_shingles"), "cls").join(groups.withColumnRenamed("node", "cls"), "cls", "left").join(counts, "cls", "left")
    found = found.withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "cls")))
    found = written(found, "found")
    discard(sets, groups)
    return found


def keep_first(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near copies: of each component one row.

    It is the one with the smallest id, of rows with that id the first by a hash of the
    text, of rows with that text too the first by the other columns. Rows with a null id,
    which lead nothing, stay, and so do rows without words.
    """
    found = _grouped(docs, shingle, percent, doc_id, text).where("component is not null and doc_id is not null")
    # rows of one id and text count as one here
    keys = found.groupBy("component", F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    keys = written(keys, "keys")
    first = written(keys.groupBy("component").agg(F.min(F.struct("_id", "_key")).alias("first")), "first")
    marked = keys.join(first, "component").withColumn("_leads", F.col("first") == F.struct("_id", "_key"))
    marked = written(marked.where("not _leads or _n > 1").select("_id", "_key", "_leads"), "copies")
    discard(keys, first)
    key, _, number = _row(doc_id, text)
    rows = docs.withColumns({"_id": number, "_key": key})
    single = meeting(rows, marked.select("_id", "_key"), "left_anti")
    # one of the rows that repeat the leading one; each task cuts its own to one before they are dealt by the struct
    leads = written(marked.where("_leads").select("_id", "_key"), "leads")
    repeated = meeting(rows, leads, "left_semi").withColumn("_both", F.struct("_id", "_key"))
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if isinstance(f.dataType, AtomicType)]
    repeated = repeated.withColumn("_rank", F.row_number().over(Window.partitionBy("_both").orderBy(*plain))).where("_rank = 1")
    names = [F.col(f"`{c}`") for c in docs.columns]
    return single.select(*names).unionByName(repeated.select(*names))


def oracle(shingle: int = 4, percent: int = 85) -> str:
    return f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {shingle - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {shingle - 1}, least(len(w), 1)) + 1)) AS i FROM d)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= {percent} * (x.n + y.n - shared)),
r(node, seen) AS (SELECT a, b FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node, min(seen) AS m FROM r GROUP BY node) x ON x.node = d.doc_id"""
