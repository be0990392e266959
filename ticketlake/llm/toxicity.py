"""Toxicity by gradient-boosted trees over dense features, calibrated isotonically.

The lexicon is learned: words, and beginnings of words, that labelled toxic texts
of the training sample hold far more often than clean ones, beside a short fixed
list of insults and of second-person words. The features of a text are densities
of lexicon hits (plain, by word beginning, and after undoing character
substitutions), hits near a second-person word, capitals, punctuation and
obfuscation rates. Spark ML grows the trees and fits the isotonic curve, on rows
that the trees have not seen.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from ticketlake.llm.common import column_bytes, without_clash, written

# --- fixed values: insults, and words that address the reader ---------------------
INSULTS = "idiot moron stupid loser trash scum worthless pathetic disgusting clown".split()
SECOND_PERSON = (
    "you your yours yourself du dich dir dein deine ihr euch sie tu te toi ton ta vous votre vos tú ti usted ustedes vosotros"
).split()

_FEATURES = [
    "insults", "insult_rate", "learned", "learned_rate", "stems", "stem_rate", "disguised", "disguised_rate",
    "best_weight", "weight_sum", "near_you", "you_rate", "capital_rate", "shout_rate", "exclaim_rate", "punct_rate",
    "odd_rate", "digit_in_word_rate", "log_words",
]
#: Lengths of word beginnings, in bytes.
_STEMS = (4, 5, 6, 7, 8)
_WINDOW = 5


def _translation(substitutions: dict[str, str]) -> bytes:
    """Lower case, other ASCII characters than letters become blanks, bytes above ASCII stay."""
    out = bytearray(range(256))
    for i in range(128):
        c = chr(i)
        out[i] = ord(c.lower()) if c.isalpha() else 32
    for a, b in substitutions.items():
        out[ord(a)] = ord(b)
    return bytes(out)


_PLAIN = _translation({})
_UNDONE = _translation({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})


@dataclass
class Lexicon:
    words: dict[bytes, float] = field(default_factory=dict)
    stems: dict[bytes, float] = field(default_factory=dict)


def _features(raw: bytes, lexicon: Lexicon, insults: frozenset, persons: frozenset) -> list[float]:
    """Of one whole text. Positions are looked at only where a word is a hit."""
    words = raw.translate(_PLAIN).split()
    n = len(words)
    if not n:
        return [0.0] * len(_FEATURES)
    distinct = set(words)
    plain, learned = distinct & insults, lexicon.words.keys() & distinct
    stems = {w: max(x for x in found) for w in distinct if (found := [lexicon.stems[w[:k]] for k in _STEMS if w[:k] in lexicon.stems])}
    hits = plain | learned | stems.keys()
    weights = [max(lexicon.words.get(w, 0.0), stems.get(w, 0.0)) for w in hits]
    weights += [4.0 for w in plain if w not in learned]
    counts = Counter(w for w in words if w in hits) if hits else Counter()
    disguised = 0
    if any(c in raw for c in b"013457@$"):
        undone = raw.translate(_UNDONE).split()
        known = insults | lexicon.words.keys()
        disguised = max(0, sum(w in known for w in undone) - sum(counts[w] for w in known & hits))
    you = sum(w in persons for w in words) if distinct & persons else 0
    near = 0
    if hits and you:
        at = [i for i, w in enumerate(words) if w in persons]
        where = [i for i, w in enumerate(words) if w in hits]
        j = np.searchsorted(at, where)
        left = np.array([at[x - 1] if x else -(10**9) for x in j])
        right = np.array([at[x] if x < len(at) else 10**9 for x in j])
        near = int((np.minimum(np.array(where) - left, right - np.array(where)) <= _WINDOW).sum())
    data = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(data, minlength=256)
    letters = kinds[65:91].sum() + kinds[97:123].sum() + kinds[128:].sum()
    capital, digits = kinds[65:91].sum(), kinds[48:58].sum()
    exclaim, marks = kinds[33] + kinds[63], kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()
    shout = 0.0
    if capital > letters * 0.1:
        tokens = raw.split()
        shout = sum(len(w) > 2 and w.isupper() for w in tokens) / len(tokens)
    total = len(data)
    rate = lambda words_: sum(counts[w] for w in words_) / n
    return [
        float(len(plain)), rate(plain), float(len(learned)), rate(learned), float(len(stems)), rate(stems),
        float(disguised), disguised / n, max(weights, default=0.0), float(sum(weights)), float(near), you / n,
        capital / max(letters, 1), shout, exclaim / total, marks / total,
        (kinds[35] + kinds[36] + kinds[37] + kinds[38] + kinds[42] + kinds[64] + kinds[95]) / total,
        digits / total, float(np.log1p(n)),
    ]


def with_features(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but texts, with ``features``: array of doubles. Null and empty texts have zeros."""
    base = without_clash(docs, "features", "_text", text)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    insults = frozenset(w.encode() for w in INSULTS)
    persons = frozenset(w.encode() for w in SECOND_PERSON)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = column_bytes(batch.column(batch.num_columns - 1))
            view = data.tobytes()
            rows = [_features(view[a:b], lexicon, insults, persons) for a, b in zip(bounds[:-1], bounds[1:])]
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(rows, pa.list_(pa.float64()))], [*batch.schema.names[:-1], "features"]
            )

    fed = docs.select(*[F.col(f"`{c}`") for c in base.columns], F.col(f"`{text}`").cast("string").alias("_text"))
    fields = kinds + ", " if kinds else ""
    return fed.mapInArrow(run, f"{fields}features array<double>")


def learn_lexicon(labelled: DataFrame, text: str = "text", label: str = "label", size: int = 400) -> Lexicon:
    """Words and word beginnings with a high log-odds for toxic texts, by the number of texts holding them.

    At most ``size`` of each come back; the counting is one aggregation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[bytes, bool], list[int]] = {}
            for raw, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set((raw or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split())
                for w in words:
                    if 3 <= len(w) <= 40:
                        found.setdefault((w, False), [0, 0])[toxic] += 1
                for s in {w[:k] for w in words if len(w) <= 40 for k in _STEMS if len(w) > k}:
                    found.setdefault((s, True), [0, 0])[toxic] += 1
            keys = list(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.bool_()),
                    pa.array([found[k][0] for k in keys], pa.int64()), pa.array([found[k][1] for k in keys], pa.int64()),
                ],
                ["term", "stem", "clean", "toxic"],
            )

    counts = labelled.select(F.col(f"`{text}`"), F.col(f"`{label}`").cast("int")).mapInArrow(
        run, "term binary, stem boolean, clean long, toxic long"
    )
    sums = counts.groupBy("term", "stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5))
    lexicon = Lexicon()
    # at least 3 toxic texts, and 3 times as many as clean ones
    strong = sums.where((F.col("toxic") >= 3) & (F.col("toxic") > 3 * F.col("clean")))
    for stem in (False, True):
        top = strong.where(F.col("stem") == stem).orderBy((odds * F.sqrt("toxic")).desc(), "term").limit(size)
        table = {bytes(r.term): float(r.w) for r in top.select("term", odds.alias("w")).collect()}
        if stem:
            lexicon.stems = table
        else:
            lexicon.words = table
    return lexicon


@dataclass
class Model:
    lexicon: Lexicon
    trees: object
    curve: object
    base_rate: float


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000, trees: int = 20, depth: int = 3, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Model from documents and their 0/1 labels, matched by id.

    The ``sample`` labelled ids with the smallest hash teach (a bound on what is
    fitted, and on what is broadcast to find their texts; scoring covers all rows):
    two fifths the lexicon, the same share the trees and a fifth the isotonic curve,
    so that no part trusts what another has already seen. With only one label present
    every text gets that label's rate. Null texts count as empty, null labels and ids
    teach nothing. Of several labels of one id the larger counts, of several texts the first in order.
    """
    marks = labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("label"))
    marks = marks.where(F.col("_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("_id").agg(F.max("label").alias("label"))
    few = written(marks.withColumn("k", F.xxhash64("_id", F.lit(5))).orderBy("k", "_id").limit(sample), "toxic-labels")
    if few.isEmpty():
        return Model(Lexicon(), None, None, 0.0)
    texts = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    # ``sample`` ids, each once, however often it stands in the documents
    picked = texts.join(F.broadcast(few), "_id").groupBy("_id").agg(F.min("text").alias("text"), F.first("label").alias("label"), F.first("k").alias("k"))
    picked = written(picked.select("text", "label", "k"), "toxic-sample")
    part = F.pmod(F.xxhash64("k"), F.lit(5))
    lexicon = learn_lexicon(picked.where(part < 2))
    table = written(with_features(picked.where(part >= 2).withColumn("part", part), lexicon), "toxic-features")
    table = table.select(array_to_vector("features").alias("features"), "label", "part")
    count = table.groupBy("label").count().collect()
    numbers = {r.label: r["count"] for r in count}
    rate = numbers.get(1, 0) / max(1, sum(numbers.values()))
    if len(numbers) < 2:
        return Model(lexicon, None, None, rate)
    grown = table.where("part < 4").coalesce(4).persist()
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=3, minInstancesPerNode=5)
    model = gbt.fit(grown)
    grown.unpersist()
    curve = None
    rest = model.transform(table.where("part = 4")).select(_raw(F.col("rawPrediction")).alias("raw"), F.col("label").cast("double").alias("label"))
    if {r.label for r in rest.select("label").distinct().collect()} == {0.0, 1.0}:
        curve = IsotonicRegression(featuresCol="raw", labelCol="label").fit(rest)
    return Model(lexicon, model, curve, rate)


def _raw(prediction: Column) -> Column:
    return F.element_at(vector_to_array(prediction), 2)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with ``score`` from 0 to 1.

    Only the text is looked at; empty and null texts are scored as texts without any
    feature. Columns named score, features and the like are replaced; equal rows stay
    as many rows with equal scores.
    """
    base = without_clash(docs, "score", "features", "rawPrediction", "probability", "prediction")
    if model.trees is None:
        return without_clash(base, text).withColumn("score", F.lit(float(model.base_rate)))
    rows = with_features(base, model.lexicon, text).withColumn("features", array_to_vector("features"))
    names = [F.col(f"`{c}`") for c in rows.columns if c != "features"]
    rows = model.trees.transform(rows).select(*names, _raw(F.col("rawPrediction")).alias("raw"), F.element_at(vector_to_array("probability"), 2).alias("p"))
    if model.curve is None:
        return rows.select(*names, F.col("p").alias("score"))
    curve = model.curve.transform(rows)
    # steps of the curve hold many rows; the trees' own probability orders rows inside a step
    return curve.select(*names, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.98 * F.col("prediction") + 0.02 * F.col("p"))).alias("score"))
