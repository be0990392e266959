"""Language identification with interpolated Kneser-Ney character models.

Training: from every language a bounded sample of labelled documents (``sample``
documents with the smallest hash of their ids; whole texts), cut into character
n-grams up to ``order``, counted by Spark per language. From the counts the
driver builds one table per order: all n-grams seen in any language, as a sorted
array of 64-bit hashes, beside their interpolated Kneser-Ney log-probabilities in
every language. An n-gram that one language lacks has its back-off there, so a
character costs one search in the highest order, and one more per order only
where no language knows the n-gram.

Scoring: the language with the lowest cross-entropy per character wins. ``score``
is the calibrated probability of that answer; a document is rejected when it looks
more like shuffled characters than like text of any learned language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ticketlake.llm.common import mix, runs_of, without_clash, written

#: Letters decide; all else is one blank between words.
_PRIME = [np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
#: Characters of a stretch, whose first text alone has a blank before it, and bytes of it that are scored at once.
_RUN, _PART = 1 << 20, 1 << 17


def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.frombuffer(bytes(chr(i).isalpha() for i in range(0x110000)), np.uint8).astype(bool)


_IS_LETTER: list[np.ndarray] = []


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, and the text each belongs to.

    Runs of other characters than letters are one blank (0); every text starts and
    ends with one.
    """
    if not _IS_LETTER:
        _IS_LETTER.append(_letters())
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer(("\0" + "\0".join(lowered) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    owner = np.zeros(len(codes), np.int32)
    owner[ends] = 1
    owner = np.cumsum(owner) - owner  # the blank after a text is still that text's
    codes = np.where(_IS_LETTER[0][np.minimum(codes, 0x10FFFF)], codes, 0)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0) | (owner[1:] != owner[:-1])
    return codes[keep], owner[keep]


def _hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram that ends at each character; the first n - 1 are not whole."""
    sums = np.zeros(len(codes), np.uint64)
    wide = codes.astype(np.uint64) + np.uint64(1)
    for back in range(n):
        sums[back:] += wide[: len(wide) - back] * _PRIME[back]
    return mix(sums)


@dataclass
class Model:
    """Per order: sorted hashes and log-probabilities [n-gram, language]; back-off weights likewise."""

    languages: list[str]
    order: int
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    context_keys: list[np.ndarray]
    backoff: list[np.ndarray]
    unseen: np.ndarray
    scale: float = 1.0
    accept: tuple[float, float] = (0.0, 0.0)

    def costs(self, codes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Sum of -log p per text and language, and the number of characters counted."""
        total, chars = np.zeros((n, len(self.languages))), np.zeros(n)
        if not len(codes):
            return total, chars
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        position = np.arange(len(codes)) - np.repeat(first, np.diff(np.append(first, len(codes))))
        logp = np.empty((len(codes), len(self.languages)), np.float32)
        open_ = np.ones(len(codes), bool)
        weight = np.zeros((len(codes), len(self.languages)), np.float32)
        for level in range(self.order, 0, -1):
            at = np.flatnonzero(open_ & (position >= level - 1))
            if len(at):
                hashes = _hashes(codes, level) if level == self.order else None
                grams = hashes[at] if hashes is not None else _hashes_at(codes, at, level)
                place = np.searchsorted(self.keys[level - 1], grams)
                place = np.minimum(place, len(self.keys[level - 1]) - 1)
                hit = self.keys[level - 1][place] == grams
                logp[at[hit]] = self.logp[level - 1][place[hit]] + weight[at[hit]]
                open_[at[hit]] = False
                miss = at[~hit]
                if level > 1 and len(miss):  # the context may be known though the n-gram is not
                    context = _hashes_at(codes, miss - 1, level - 1)
                    spot = np.searchsorted(self.context_keys[level - 1], context)
                    spot = np.minimum(spot, len(self.context_keys[level - 1]) - 1)
                    known = self.context_keys[level - 1][spot] == context
                    weight[miss[known]] += self.backoff[level - 1][spot[known]]
        logp[open_] = self.unseen + weight[open_]
        logp[first] = 0  # the blank before a text
        total[owner[first]] = -np.add.reduceat(logp, first, axis=0, dtype=np.float64)
        chars[owner[first]] = np.diff(np.append(first, len(codes))) - 1
        return total, chars


def _hashes_at(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    sums = np.zeros(len(at), np.uint64)
    for back in range(n):
        sums += (codes[at - back].astype(np.uint64) + np.uint64(1)) * _PRIME[back]
    return mix(sums)


# --- training --------------------------------------------------------------------


def _count_grams(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                codes, owner = characters(texts)
                for n in range(1, order + 1):
                    whole = np.zeros(len(codes), bool)
                    whole[n - 1 :] = owner[n - 1 :] == owner[: len(owner) - n + 1]
                    at = np.flatnonzero(whole)
                    _, where, counts = np.unique(_hashes(codes, n)[at], return_index=True, return_counts=True)
                    grams = codes[at[where][:, None] + np.arange(1 - n, 1)]
                    flat = "".join(map(chr, grams.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams)), pa.array([flat[i : i + n] for i in range(0, len(flat), n)], pa.string()), pa.array(counts)],
                        ["lang", "gram", "n"],
                    )

    return run


def _kneser_ney(counts: dict[str, int], order: int, alphabet: int) -> tuple[list[dict[str, float]], list[dict[str, float]]]:
    """Interpolated probabilities and back-off weights per order, of one language.

    Below the highest order an n-gram counts by the number of characters seen before it.
    """
    levels: list[dict[str, int]] = [{} for _ in range(order)]
    for gram, n in counts.items():
        if len(gram) == order:
            levels[order - 1][gram] = n
    for level in range(order - 1, 0, -1):
        lower = levels[level - 1]
        for gram in levels[level] if level < order - 1 else [g for g in counts if len(g) == level + 1]:
            lower[gram[1:]] = lower.get(gram[1:], 0) + 1
    probs: list[dict[str, float]] = [{} for _ in range(order)]
    weights: list[dict[str, float]] = [{} for _ in range(order)]
    for level in range(order):
        grams = levels[level]
        ones, twos = sum(v == 1 for v in grams.values()), sum(v == 2 for v in grams.values())
        discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
        totals: dict[str, int] = {}
        kinds: dict[str, int] = {}
        for gram, n in grams.items():
            totals[gram[:-1]] = totals.get(gram[:-1], 0) + n
            kinds[gram[:-1]] = kinds.get(gram[:-1], 0) + 1
        for context, total in totals.items():
            weights[level][context] = discount * kinds[context] / total
        below = probs[level - 1] if level else {}
        for gram, n in grams.items():
            lower = below.get(gram[1:], 1.0 / alphabet) if level else 1.0 / alphabet
            probs[level][gram] = max(n - discount, 0) / totals[gram[:-1]] + weights[level][gram[:-1]] * lower
    return probs, weights


def _hash_of(grams: list[str]) -> np.ndarray:
    if not grams:
        return np.zeros(0, np.uint64)
    n = len(grams[0])
    if not n:
        return np.full(len(grams), 0, np.uint64)
    codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)
    sums = np.zeros(len(grams), np.uint64)
    for back in range(n):
        sums += (codes[:, n - 1 - back].astype(np.uint64) + np.uint64(1)) * _PRIME[back]
    return mix(sums)


def _build(counts: dict[str, dict[str, int]], order: int) -> Model:
    languages = sorted(counts)
    alphabet = len({c for by in counts.values() for g in by if len(g) == 1 for c in g}) + 1
    parts = {lang: _kneser_ney(counts[lang], order, alphabet) for lang in languages}
    keys, logp, context_keys, backoff = [], [], [], []
    lower: dict[str, list[float]] = {}
    for level in range(order):
        contexts = sorted({c for lang in languages for c in parts[lang][1][level]})
        grams = sorted({g for lang in languages for g in parts[lang][0][level]})
        here: dict[str, list[float]] = {}
        for gram in grams:
            base = lower.get(gram[1:]) if level else None
            row = []
            for i, lang in enumerate(languages):
                p = parts[lang][0][level].get(gram)
                if p is None:
                    p = parts[lang][1][level].get(gram[:-1], 1.0) * (base[i] if base else 1.0 / alphabet)
                row.append(p)
            here[gram] = row
        hashes, spots = _hash_of(grams), _hash_of(contexts) if level else np.zeros(0, np.uint64)
        order_of, spot_order = np.argsort(hashes), np.argsort(spots)
        keys.append(hashes[order_of])
        logp.append(np.log(np.array([here[g] for g in grams]))[order_of].astype(np.float32))
        context_keys.append(spots[spot_order])
        table = [[parts[lang][1][level].get(c, 1.0) for lang in languages] for c in contexts] if level else []
        backoff.append(np.log(np.array(table))[spot_order].astype(np.float32) if table else np.zeros((0, len(languages)), np.float32))
        lower = here
    return Model(languages, order, keys, logp, context_keys, backoff, np.full(len(languages), -np.log(alphabet), np.float32))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a one-dimensional logistic fit (Newton steps, slightly ridged)."""
    a = b = 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([(x * (y - p)).sum() - 1e-3 * a, (y - p).sum() - 1e-3 * b])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def _rates(model: Model):
    """Costs per character of calibration texts, whole, and of the same characters shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for real in (True, False):
                texts = batch.column(1).to_pylist()
                if not real:
                    rng = np.random.default_rng(7)
                    texts = ["".join(rng.permutation(list(t))) for t in texts]
                codes, owner = characters(texts)
                costs, chars = model.costs(codes, owner, len(texts))
                rate = costs / np.maximum(chars, 1)[:, None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs), pa.array([real] * len(texts)), pa.array(chars), pa.array(list(rate), pa.list_(pa.float64()))],
                    ["lang", "real", "chars", "rate"],
                )

    return run


def _calibrate(model: Model, held: DataFrame) -> None:
    """Temperature of the score and the line between text and shuffled characters, from texts not counted."""
    rows = held.mapInArrow(_rates(model), "lang string, real boolean, chars double, rate array<double>").collect()
    rows = [r for r in rows if r.chars > 20]
    if not rows:
        return
    rate, real = np.array([r.rate for r in rows]), np.array([r.real for r in rows])
    model.accept = _logistic(rate.min(axis=1), real.astype(float))
    truth = np.array([model.languages.index(r.lang) if r.lang in model.languages else -1 for r in rows])
    known = real & (truth >= 0)
    best_loss = np.inf
    for scale in (0.25, 0.5, 1, 2, 4, 8, 16, 32, 64):
        p = _posterior(rate[known], scale)
        loss = -np.log(np.maximum(p[np.arange(known.sum()), truth[known]], 1e-9)).mean() if known.any() else 0.0
        if loss < best_loss - 1e-6:
            model.scale, best_loss = float(scale), loss


def _posterior(rate: np.ndarray, scale: float) -> np.ndarray:
    x = -scale * rate
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


#: Most languages that are learned, those with most rows, and bytes of all texts that teach.
LANGUAGES, SAMPLE_BYTES = 256, 32 << 20


def pick(rows: DataFrame, n: int, languages: int, sample_bytes: int) -> DataFrame:
    """``lang``, ``text`` and ``place`` of up to ``n`` texts for each language, those with the smallest hashes.

    Which ones is found on hashes alone: every task keeps its n smallest of each language and part
    of the rows, then the parts meet. Texts are filtered by what was found, and only those
    are moved, one of each. A language's texts stop where its share of ``sample_bytes`` is full.
    """
    known = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    known = written(known.select("lang"), "languages")
    marks = rows.select("lang", "k", F.xxhash64("text").alias("t"), F.octet_length("text").alias("size")).join(F.broadcast(known), "lang")
    salt = F.pmod(F.xxhash64("k", "t"), F.lit(64))
    part = F.row_number().over(Window.partitionBy("lang", "salt").orderBy("k", "t"))
    whole = Window.partitionBy("lang").orderBy("k", "t")
    # equal rows are one, so that a text that is there very often takes one place
    few = marks.withColumn("salt", salt).dropDuplicates(["lang", "salt", "k", "t"]).withColumn("nth", part).where(F.col("nth") <= n)
    few = few.withColumn("place", F.row_number().over(whole)).where(F.col("place") <= n)
    before = F.sum("size").over(whole.rowsBetween(Window.unboundedPreceding, -1))
    share = sample_bytes / F.greatest(F.lit(1), F.lit(known.count()))
    few = written(few.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < share).select("lang", "k", "t", "place"), "language-marks")
    texts = rows.withColumn("t", F.xxhash64("text")).join(few, ["lang", "k", "t"])
    return texts.groupBy("lang", "k", "t").agg(F.first("text").alias("text"), F.first("place").alias("place")).select("lang", "text", "place")


def train(labelled: DataFrame, order: int = 4, sample: int = 400, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Model from rows with a language. ``sample`` documents per language are counted and a
    quarter as many calibrate it, of at most ``LANGUAGES`` languages and ``SAMPLE_BYTES`` of text
    (a text that is begun counts whole); so what reaches the driver, the n-grams of these, is bounded.

    Null languages and null texts teach nothing; equal rows teach once. None if nothing is left.
    """
    order_key = F.xxhash64(F.col(f"`{doc_id}`"), F.lit(11))
    rows = labelled.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"), order_key.alias("k")
    )
    picked = written(pick(rows, sample + sample // 4, LANGUAGES, SAMPLE_BYTES), "language-sample")
    # every fifth place calibrates, so a language with few documents still teaches
    teach, held = picked.where("place % 5 <> 0"), picked.where("place % 5 = 0")
    counted = (
        teach.select("lang", "text")
        .mapInArrow(_count_grams(order), "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    counts: dict[str, dict[str, int]] = {}
    for name, gram, n in counted.toPandas().itertuples(index=False):
        counts.setdefault(name, {})[gram] = int(n)
    if not counts:
        return None
    model = _build(counts, order)
    _calibrate(model, held.select("lang", "text"))
    return model


# --- scoring ---------------------------------------------------------------------

_RESULT = "lang_pred string, score double, cross_entropy double, accepted boolean"


def _predict(model: Model | None, place: int, width: int):
    """Scores of the texts in column ``place``, beside the first ``width`` columns."""

    def score(texts: list[str | None], after: int) -> list[pa.Array]:
        n = len(texts)
        codes, owner = characters([""] * after + [t or "" for t in texts])
        codes, owner = codes[owner >= after], owner[owner >= after] - after
        letters = np.bincount(owner[codes != 0], minlength=n)[:n] > 0
        if model is None:
            nothing = pa.nulls(n, pa.float64())
            return [pa.array(["und"] * n), pa.array([0.0] * n), nothing, pa.array([False] * n)]
        costs, chars = model.costs(codes, owner, n)
        rate = costs / np.maximum(chars, 1)[:, None]
        best = rate.argmin(axis=1)
        sure = _posterior(rate, model.scale)[np.arange(n), best]
        low = rate[np.arange(n), best]
        a, b = model.accept
        # log-odds of text against noise; the shorter a text, the clearer they must be to reject it
        fine = letters & (a * low + b >= -2 - 200 / np.maximum(chars, 1))
        names = [model.languages[i] if ok else "und" for i, ok in zip(best, letters)]
        return [pa.array(names), pa.array(np.where(letters, sure, 0.0)), pa.array(low, mask=~letters), pa.array(fine)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            chars, sizes = (np.concatenate(([0], np.cumsum(pc.fill_null(n, 0).to_numpy(zero_copy_only=False), dtype=np.int64))) for n in (pc.utf8_length(texts), pc.binary_length(texts)))
            parts = [(start, start + i, start + j) for start, stop in runs_of(chars, _RUN) for i, j in runs_of(sizes[start : stop + 1], _PART)]
            for start, first, last in parts:
                got = score(texts.slice(first, last - first).to_pylist(), int(first > start))
                rest = batch.slice(first, last - first)
                rest = [rest.column(i) for i in range(width)]
                yield pa.RecordBatch.from_arrays([*rest, *got], [*batch.schema.names[:width], "lang_pred", "score", "cross_entropy", "accepted"])

    return run


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred``, ``score``, ``cross_entropy`` and ``accepted``.

    Only the text is looked at. Null texts and texts without a letter are "und" with
    score 0 and not accepted. Between equal entropies the first language in
    alphabetical order wins. Columns with these names are replaced. Equal rows stay
    as many rows; without a model every text is "und".
    """
    base = without_clash(docs, "lang_pred", "score", "cross_entropy", "accepted", "_text")
    # a text that is kept goes to Python once
    kept = base.columns.count(text) == 1
    fed = base if kept else base.withColumn("_text", F.col(f"`{text}`"))
    place = base.columns.index(text) if kept else len(base.columns)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return fed.mapInArrow(_predict(model, place, len(base.columns)), f"{kinds}, {_RESULT}")

