"""Personal data by rules and a skip-chain conditional random field.

Rules find e-mail addresses, IP addresses, card and phone numbers. The random field
then labels the words of a document that hold a digit or "@" with one of these kinds
or none: neighbouring words share chain potentials, and equal words, or words ending
in the same seven digits, share skip potentials however far apart they stand, so that
an entity recognised once is recognised where its form alone would not tell. Sum-product
messages run over the loopy graph of all documents of a batch at once. Each word is
joined to the next of its equals only, so the graph is linear in the text.

Potentials are trained by pseudo-likelihood on the rules' own spans in a bounded
sample of documents; form features are randomly blanked so that context gets weight. Rules catch
an equal word by its form as well, so the sample also teaches on repeats that they cannot
catch: shortened forms of a span's words, labelled like the span where a skip link leads to
it, and not personal data where none does.
Spans that the field adds must be near certain and never touch a rule's span.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# --- fixed values: kinds in order, and the patterns of the rules -------------------
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SIGN = re.compile(r"[0-9@]")
_STATES = len(KINDS) + 1
#: Potential of a state that is given, and against all others.
_GIVEN = 15.0

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield 0, start, done
        # a run before a failed "@" cannot match, and the next run begins behind it
        done = max(done, at + 1)
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """The rules' spans by start, then kind."""
    if not _SIGN.search(text):
        return []
    out = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                out.append((3, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0]))


# --- the graph ---------------------------------------------------------------------

_FORM = 16


def _form(word: str) -> list[float]:
    """Features of a word's own form."""
    digits = sum(c.isdigit() for c in word)
    letters = sum(c.isalpha() for c in word)
    dots = word.count(".")
    return [
        1.0, float("@" in word), float(word[0] == "+"), float("(" in word or ")" in word), float("-" in word), float(dots >= 3),
        float(dots in (1, 2)), float(digits == len(word)), float(digits <= 3), float(4 <= digits <= 8), float(9 <= digits <= 11),
        float(12 <= digits <= 19), float(digits > 19), float(letters > 0), float(letters > digits),
        float(12 <= digits <= 19 and luhn("".join(c for c in word if "0" <= c <= "9") or "1")),
    ]


@dataclass
class Graph:
    spans: list[tuple[int, int, int]]  # document, start, end of each word
    form: np.ndarray
    chain: np.ndarray  # pairs of neighbouring words
    skip: np.ndarray  # pairs of equal or similar words


def build_graph(texts: list[str], base: list[list[Span]] | None = None) -> Graph:
    """Words with a digit or "@", each linked to the word before that says the same, and to the last one in a rule's span.

    The last word of a rule's span also stands for the whole span's last seven digits.
    """
    spans: list[tuple[int, int, int]] = []
    forms: list[list[float]] = []
    chain: list[tuple[int, int]] = []
    skip: list[tuple[int, int]] = []
    for d, text in enumerate(texts):
        if not _SIGN.search(text):
            continue
        last: dict[str, int] = {}
        sure: dict[str, int] = {}
        inside = [(start, end) for _, start, end in base[d]] if base else []
        whole = {end: "".join(_DIGITS.findall(text[start:end])) for _, start, end in base[d]} if base else {}
        before = -2
        for i, m in enumerate(_WORD.finditer(text)):
            if not _SIGN.search(m.group()):
                continue
            word = m.group().strip(".,;:!?\"'")
            if not _SIGN.search(word):
                continue
            at = m.start() + m.group().index(word)
            node = len(spans)
            spans.append((d, at, at + len(word)))
            forms.append(_form(word))
            if before == i - 1:
                chain.append((node - 1, node))
            before = i
            digits = "".join(_DIGITS.findall(word))
            keys = ["=" + word.lower()]
            for number in dict.fromkeys((digits, whole.get(at + len(word), ""))):
                if len(number) >= 7:
                    keys.append("~" + number[-7:])
            given = any(start < at + len(word) and at < end for start, end in inside[bisect_left(inside, (at - 100, 0)) : bisect_left(inside, (at + len(word), 0))])
            for key in keys:
                for known in (last, sure):
                    if key in known:
                        skip.append((known[key], node))
                last[key] = node
                if given:
                    sure[key] = node
    pairs = lambda x: np.array(sorted(set(x)), np.int64).reshape(-1, 2)
    return Graph(spans, np.array(forms, np.float64).reshape(-1, _FORM), pairs(chain), pairs(skip))


@dataclass
class Field:
    unary: np.ndarray  # form, state
    chain: np.ndarray  # state of the left word, of the right word
    skip: np.ndarray  # symmetric


def marginals(graph: Graph, field: Field, rounds: int = 8, known: np.ndarray | None = None) -> np.ndarray:
    """Approximate probability of each state of each word, by sum-product messages; ``known`` has states above 0 that are given."""
    unary = graph.form @ field.unary
    if known is not None:
        given = np.flatnonzero(known)
        unary[given] = -_GIVEN
        unary[given, known[given]] = _GIVEN
    pairs = np.concatenate((graph.chain, graph.chain[:, ::-1], graph.skip, graph.skip[:, ::-1]))
    n, k = len(graph.chain), len(graph.skip)
    tables = np.stack([field.chain, field.chain.T, field.skip, field.skip.T])
    which = np.repeat(np.arange(4), [n, n, k, k])
    reverse = np.concatenate((np.arange(n, 2 * n), np.arange(n), np.arange(2 * n + k, 2 * n + 2 * k), np.arange(2 * n, 2 * n + k)))
    messages = np.zeros((len(pairs), _STATES))
    belief = unary.copy()
    for _ in range(rounds if len(pairs) else 0):
        source = belief[pairs[:, 0]] - messages[reverse]
        joint = source[:, :, None] + tables[which]
        top = joint.max(axis=1)
        new = top + np.log(np.exp(joint - top[:, None, :]).sum(axis=1))
        new -= new.max(axis=1, keepdims=True)
        messages = 0.5 * messages + 0.5 * new
        belief = unary.copy()
        np.add.at(belief, pairs[:, 1], messages)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _reached(graph: Graph, known: np.ndarray) -> np.ndarray:
    """Which words hang together with one whose state is given, by chains and skip links."""
    pairs = np.concatenate((graph.chain, graph.skip))
    reached = known > 0
    while len(pairs):
        more = reached.copy()
        more[pairs[reached[pairs[:, 0]], 1]] = True
        more[pairs[reached[pairs[:, 1]], 0]] = True
        if (more == reached).all():
            break
        reached = more
    return reached


def _gold(graph: Graph, base: list[list[Span]]) -> np.ndarray:
    """State of each word by the rules: 0 none, else kind + 1."""
    out = np.zeros(len(graph.spans), np.int64)
    for d in {s[0] for s in graph.spans}:
        base[d].sort(key=lambda s: s[1])
    for i, (d, a, b) in enumerate(graph.spans):
        for kind, start, end in base[d]:
            if start >= b:
                break
            if end > a and min(b, end) - max(a, start) >= (b - a) / 2:
                out[i] = kind + 1
    return out


# --- training ----------------------------------------------------------------------


def short_forms(word: str) -> list[str]:
    """How a number may be said again: its last seven or ten digits, plain or parted, and the word as it is."""
    digits = "".join(_DIGITS.findall(word))
    out = [word]
    if len(digits) >= 7:
        out += [digits[-7:], f"{digits[-7:-4]}-{digits[-4:]}"]
    if len(digits) >= 10:
        out += [digits[-10:], f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}"]
    return out


def _repeats(texts: list[str], base: list[list[Span]]) -> np.ndarray:
    """Cases of words that say a span again: linked ones have its state, the same words without a link have none."""
    rows = []
    for text, spans in zip(texts, base):
        for kind, a, b in spans:
            word = text[a:b]
            if " " in word:
                word = "".join(_DIGITS.findall(word))
            if not ("@" in word or len("".join(_DIGITS.findall(word))) >= 7):
                continue
            far = np.zeros(_STATES)
            far[kind + 1] = 1
            alone = np.zeros(2 * _STATES)
            for form in map(_form, short_forms(word)):
                rows.append(np.concatenate((form, alone, far, [kind + 1])))
            for form in map(_form, short_forms(word)[1:]):
                rows.append(np.concatenate((form, alone, np.zeros(_STATES), [0])))
    return np.array(rows).reshape(-1, _FORM + 3 * _STATES + 1)


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of equal training cases: form, neighbours' states, state."""
    for batch in batches:
        texts = [t or "" for t in batch.column(0).to_pylist()]
        base = [base_spans(t) for t in texts]
        graph = build_graph(texts, base)
        if not graph.spans:
            continue
        gold = _gold(graph, base)
        left, right, far = (np.zeros((len(gold), _STATES)) for _ in range(3))
        for a, b in graph.chain:
            left[b, gold[a]], right[a, gold[b]] = 1, 1
        for a, b in graph.skip:
            far[a, gold[b]] += 1
            far[b, gold[a]] += 1
        cases = np.hstack((graph.form, left, right, np.minimum(far, 2), gold[:, None]))
        rows, counts = np.unique(np.vstack((cases, _repeats(texts, base))), axis=0, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.list_(pa.float64())), pa.array(counts)], ["case", "n"])


def train(docs: DataFrame, sample: int = 4000, doc_id: str = "doc_id", text: str = "text") -> Field:
    """Potentials from at most ``sample`` documents, those with the smallest hash of id and text.

    Rows with equal id and text count once, so rows without an id, or with one, are no larger a sample.
    The cases are counted by Spark; the driver gets distinct cases, of which there are
    as many as forms. Without any candidate word the field is all zeros and adds nothing.
    """
    key = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), F.lit(17))
    last = docs.select(key.alias("k")).distinct().orderBy("k").limit(sample).agg(F.max("k")).first()[0]
    field = Field(np.zeros((_FORM, _STATES)), np.zeros((_STATES, _STATES)), np.zeros((_STATES, _STATES)))
    if last is None:
        return field
    picked = docs.where(key <= last).groupBy(key.alias("k")).agg(F.first(F.col(f"`{text}`")).alias("text")).select("text")
    cases = picked.mapInArrow(_training_rows, "case array<double>, n long").groupBy("case").agg(F.sum("n").alias("n")).collect()
    if not cases:
        return field
    cases.sort(key=lambda r: tuple(r.case))
    table, weight = np.array([r.case for r in cases]), np.array([float(r.n) for r in cases])
    x, y = table[:, :-1], np.eye(_STATES)[table[:, -1].astype(int)]
    # every case once as it is and twice with parts of its form blanked
    rng = np.random.default_rng(23)
    blanked = [x]
    for _ in range(2):
        z = x.copy()
        z[:, 1:_FORM] *= rng.random((len(x), _FORM - 1)) > 0.3
        blanked.append(z)
    x, y, weight = np.vstack(blanked), np.vstack([y] * 3), np.tile(weight, 3) / (3 * weight.sum())
    w = np.zeros((x.shape[1], _STATES))
    speed = np.zeros_like(w)
    for _ in range(600):
        p = x @ w
        p = np.exp(p - p.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed + x.T @ ((y - p) * weight[:, None]) - 1e-4 * w
        w += 0.5 * speed
    left, right, far = w[_FORM : _FORM + _STATES], w[_FORM + _STATES : _FORM + 2 * _STATES], w[_FORM + 2 * _STATES :]
    return Field(w[:_FORM], (left + right.T) / 2, (far + far.T) / 2)


# --- detection ---------------------------------------------------------------------

SURE = 0.95


def detect(texts: list[str], field: Field) -> tuple[list[list[Span]], list[list[Span]]]:
    """The rules' spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    every = [list(b) for b in base]
    graph = build_graph(texts, base)
    if not graph.spans or not field.unary.any():
        return base, every
    # the rules' words are given; only what hangs together with one of them may be labelled
    known = _gold(graph, base)
    p = marginals(graph, field, known=known)
    states, sure = np.where(_reached(graph, known), p.argmax(axis=1), 0), p.max(axis=1)
    # starts of the rules' spans, and the largest end of all up to each
    taken = {}
    for d in {s[0] for s in graph.spans}:
        spans = sorted((s, e) for _, s, e in base[d])
        taken[d] = [s for s, _ in spans], list(accumulate((e for _, e in spans), max))
    follows = set(map(tuple, graph.chain.tolist()))
    held: tuple[int, int] | None = None  # the node and kind that a span may go on from
    for i, (d, a, b) in enumerate(graph.spans):
        state = int(states[i])
        starts, ends = taken[d]
        at = bisect_left(starts, b)
        free = not at or ends[at - 1] <= a
        if not state or sure[i] < SURE or not free:
            held = None
            continue
        if held == (i - 1, state) and (i - 1, i) in follows:
            kind, start, _ = every[d][-1]
            every[d][-1] = (kind, start, b)
        else:
            every[d].append((state - 1, a, b))
        held = (i, state)
    return base, [sorted(e, key=lambda s: (s[1], s[0], s[2])) for e in every]


def _said(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[Span]) -> str:
    """Spans become <kind>; overlapping ones one placeholder of the first kind."""
    out, done = [], 0
    for kind, a, b in spans:
        if a >= done:
            out += [text[done:a], f"<{KINDS[kind]}>"]
        done = max(done, b)
    return "".join([*out, text[done:]]) if out else text


_RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
_NAMES = [x.split()[0] for x in _RESULT.split(", ")]
_CHUNK = 2000


def find_pii(docs: DataFrame, field: Field, text: str = "text", mask: bool = False) -> DataFrame:
    """All columns of ``docs`` with counts of the rules' spans, ``base_sha256``, ``spans`` and ``n_added``.

    Offsets are code points, ends exclusive. ``mask`` also replaces every span in the
    text by its kind. Null texts count as empty and stay null; texts without personal
    data have "" and the hash of "". Columns with the result's names are replaced;
    equal rows stay as many rows with equal results.
    """
    clash = {n.lower() for n in _NAMES} | {"_text"}
    base = [f for f in docs.schema.fields if f.name.lower() not in clash]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base)
    place = [f.name for f in base].index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _CHUNK):
                batch = whole.slice(at, _CHUNK)
                given = batch.column(place).to_pylist()
                texts = [t or "" for t in given]
                found, every = detect(texts, field)
                rest = [batch.column(i) for i in range(batch.num_columns)]
                if mask:
                    kind = batch.schema.field(place).type
                    rest[place] = pa.array([t if t is None else masked(t, e) for t, e in zip(given, every)], kind)
                counts = np.zeros((len(texts), len(KINDS)), np.int64)
                for d, spans in enumerate(found):
                    for kind_, _, _ in spans:
                        counts[d, kind_] += 1
                added = [len(e) - len(b) for e, b in zip(every, found)]
                hashes = [hashlib.sha256(_said(b).encode()).hexdigest() for b in found]
                columns = [*(pa.array(counts[:, k]) for k in range(len(KINDS))), pa.array(hashes), pa.array([_said(e) for e in every], pa.string()), pa.array(added, pa.int64())]
                yield pa.RecordBatch.from_arrays([*rest, *columns], [*batch.schema.names, *_NAMES])

    return docs.select(*[F.col(f"`{f.name}`") for f in base]).mapInArrow(run, f"{kinds}, {_RESULT}")
