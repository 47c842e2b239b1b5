"""Personal data by patterns and a skip-chain conditional random field.

Base spans are matches of fixed patterns with checks. A conditional random field over the
tokens that hold a digit or an at sign then adds spans the patterns miss. Its factors:

* a token's shape (its outer punctuation stripped);
* the label of the token right before or after (a chain through neighbours);
* skip edges between occurrences of the same token, or of the same digits, anywhere in the
  document, so that one entity carries one label throughout.

Tokens inside a base span are clamped to its kind. Marginals come from loopy sum-product
message passing over all documents of a batch at once. The weights are fitted by
pseudo-likelihood on a bounded sample of documents, with the base spans as labels.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.text import narrow, over_batches

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 4000  # documents the weights are fitted on
LONGEST_SAMPLE = 32_000  # bytes; with SAMPLE_ROWS at most 128 MB reach the driver
FIT_STEPS = 300
ROUNDS = 12
DAMPING = 0.3
SURE = 0.9  # marginal from which a token is added

# The base patterns. Possessive repeats give the same matches in linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S*[0-9@]\S*")
_NOT_DIGIT = re.compile(r"[^0-9]")
_LOCAL_CLASS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """From each at sign outwards: the local part is all of its class back to the last match."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CLASS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Checked leftmost matches of each kind, in the order of ``KINDS``."""
    if not _DIGIT.search(text):
        return [emails(text), [], [], []]
    ips = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))]
    cards = []
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            cards.append(m.span())
    phones = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return [emails(text), ips, cards, phones]


# ---- the random field -----------------------------------------------------------------

_EDGES = "\"'`.,;:!?%&$*#<>[]{}|=~"
_FEATURES = 18


def _stripped(token: str) -> tuple[int, int]:
    start, end = 0, len(token)
    while start < end and token[start] in _EDGES:
        start += 1
    while end > start and token[end - 1] in _EDGES:
        end -= 1
    return start, end


def features(core: str) -> list[float]:
    """Shape of a token; names nothing that depends on the words around it."""
    digits = _NOT_DIGIT.sub("", core)
    n, letters = len(digits), any(c.isalpha() for c in core)
    dots, at = core.count("."), "@" in core
    local, _, host = core.partition("@")
    return [
        1.0, at and bool(local) and "." in host.strip("."), at, dots == 3 and not letters and 4 <= n <= 12,
        not letters and 16 <= n <= 19 and luhn(digits), not letters and 16 <= n <= 19, not letters and 4 <= n <= 15,
        not letters and n <= 3, core[:1] == "+", core[:1] == "+" and not letters and n <= 3, core[:1] == "(" and core[-1:] == ")",
        core[:1] == "(" and core[-1:] == ")" and n == 3, "-" in core and not letters, "-" in core and not letters and n == 7,
        letters and not at, dots > 0 and not letters and dots != 3, not letters and n > 19, n == len(core),
    ]


@dataclass
class Graph:
    """Tokens of all documents of a batch; chain and skip edges as index pairs."""

    doc: list
    start: list
    end: list
    label: np.ndarray  # of base spans; 0 elsewhere
    clamped: np.ndarray
    shape: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def graph_of(texts: list[str], spans: list[list[list[tuple[int, int]]]]) -> Graph:
    doc, start, end, label, shape, chain, skip = [], [], [], [], [], [], []
    for d, text in enumerate(texts):
        marks = sorted((s, e, k + 1) for k, own in enumerate(spans[d]) for s, e in own)
        at, before, last = 0, -1, {}
        for m in _TOKEN.finditer(text):
            s, e = _stripped(m.group())
            s, e = m.start() + s, m.start() + e
            if s == e:
                continue
            while at < len(marks) and marks[at][1] <= s:
                at += 1
            inside = at < len(marks) and marks[at][0] < e
            core, i = text[s:e], len(doc)
            doc.append(d), start.append(s), end.append(e), label.append(marks[at][2] if inside else 0)
            shape.append(features(core))
            if before >= 0 and not text[before : m.start()].strip():
                chain.append((i - 1, i))
            before = m.end()
            digits = _NOT_DIGIT.sub("", core)
            for key in {core.lower(), digits[-7:] if len(digits) >= 7 and "@" not in core else core.lower()}:
                if key in last:
                    skip.append((last[key], i))
                last[key] = i
    labels = np.array(label, int)
    return Graph(
        doc, start, end, labels, labels > 0, np.array(shape, float).reshape(-1, _FEATURES),
        np.array(chain, int).reshape(-1, 2), np.array(skip, int).reshape(-1, 2),
    )


@dataclass(frozen=True)
class Model:
    shape: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels, symmetric
    skip: np.ndarray


LABELS = len(KINDS) + 1


def _neighbours(edges: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """How many neighbours of each token have each label."""
    counts = np.zeros((len(labels), LABELS))
    if len(edges):
        np.add.at(counts, (edges[:, 0], labels[edges[:, 1]]), 1)
        np.add.at(counts, (edges[:, 1], labels[edges[:, 0]]), 1)
    return counts


def fit(graph: Graph) -> Model:
    """Pseudo-likelihood: every label given the shape and the labels of its neighbours; Nesterov steps."""
    y = np.eye(LABELS)[graph.label]
    x = np.concatenate([graph.shape, _neighbours(graph.chain, graph.label), _neighbours(graph.skip, graph.label)], axis=1)
    weights = np.zeros((x.shape[1], LABELS))
    if not len(y):
        weights[0, 0] = 10.0
    ahead, rate = weights.copy(), 1.0 / (0.25 * max(1.0, float((x**2).sum()) / max(1, len(x))))
    for step in range(FIT_STEPS if len(y) else 0):
        z = x @ ahead
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        moved = ahead + rate * (x.T @ (y - p) / len(y) - 1e-4 * ahead)
        ahead = moved + step / (step + 3) * (moved - weights)
        weights = moved
    chain, skip = weights[_FEATURES : _FEATURES + LABELS], weights[_FEATURES + LABELS :]
    return Model(weights[:_FEATURES], (chain + chain.T) / 2, (skip + skip.T) / 2)


def _normal(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def marginals(graph: Graph, model: Model) -> np.ndarray:
    """Loopy sum-product in the log domain, damped, a fixed number of rounds."""
    own = graph.shape @ model.shape
    own[graph.clamped] = -50.0
    own[graph.clamped, graph.label[graph.clamped]] = 0.0
    own = _normal(own)
    kinds = [(graph.chain, model.chain), (graph.skip, model.skip)]
    source = np.concatenate([np.concatenate([e[:, 0], e[:, 1]]) for e, _ in kinds])
    target = np.concatenate([np.concatenate([e[:, 1], e[:, 0]]) for e, _ in kinds])
    if not len(source):
        return np.exp(own)
    sizes = [len(e) for e, _ in kinds]
    back, base = [], 0  # the message the other way along the same edge
    for n in sizes:
        back += [np.arange(base + n, base + 2 * n), np.arange(base, base + n)]
        base += 2 * n
    back = np.concatenate(back)
    potential = [np.exp(w - w.max()) for _, w in kinds]
    messages = np.zeros((len(source), LABELS))
    for _ in range(ROUNDS):
        belief = own.copy()
        np.add.at(belief, target, messages)
        out = np.exp(_normal(belief[source] - messages[back]))
        cut = 2 * sizes[0]
        new = np.concatenate([out[:cut] @ potential[0], out[cut:] @ potential[1]])
        messages = DAMPING * messages + (1 - DAMPING) * _normal(np.log(np.maximum(new, 1e-30)))
    belief = own.copy()
    np.add.at(belief, target, messages)
    return np.exp(_normal(belief))


def added_spans(texts: list[str], spans: list[list[list[tuple[int, int]]]], model: Model) -> list[list[list[tuple[int, int]]]]:
    """Spans of tokens the field is sure of, outside all base spans; neighbours of one kind are one span."""
    made = [[[], [], [], []] for _ in texts]
    graph = graph_of(texts, spans)
    if not len(graph.doc):
        return made
    sure = marginals(graph, model)
    best = sure.argmax(axis=1)
    linked = {int(b) for a, b in graph.chain}
    for i in np.flatnonzero((best > 0) & ~graph.clamped & (sure.max(axis=1) >= SURE)):
        own = made[graph.doc[i]][best[i] - 1]
        if int(i) in linked and own and own[-1][1] == graph.end[i - 1]:
            own[-1] = (own[-1][0], graph.end[i])
        else:
            own.append((graph.start[i], graph.end[i]))
    return made


def listed(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind, own in zip(KINDS, spans) for s, e in sorted(own))


def train(docs: DataFrame) -> Model:
    """Fitted on a bounded number of documents: those whose ids come first in hash order, one row for each id."""
    rows = narrow(docs).filter(F.octet_length("text") <= LONGEST_SAMPLE)
    first = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    chosen = F.broadcast(first.withColumnRenamed("doc_id", "_id"))  # at most SAMPLE_ROWS numbers
    found = rows.join(chosen, F.col("doc_id") == F.col("_id")).groupBy("doc_id").agg(F.min("text").alias("text"))
    texts = sorted(r["text"] for r in found.select("text").collect())
    return fit(graph_of(texts, [base_spans(t) for t in texts]))


def find(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, counts and lists of base and all spans for every row; positions are code points, end
    exclusive. A null or empty text has none."""
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans", "n_added"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        base = [base_spans(t) for t in texts]
        added = added_spans(texts, base, model)
        every = [[b + a for b, a in zip(*both)] for both in zip(base, added)]
        counts = [pa.array([len(b[k]) for b in base], pa.int64()) for k in range(4)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), *counts, pa.array(map(listed, base), pa.string()), pa.array(map(listed, every), pa.string()),
                pa.array([sum(map(len, a)) for a in added], pa.int64()),
            ],
            names=names,
        )

    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, spans string, n_added bigint"
    return over_batches(narrow(docs), work, schema)


def query(docs: DataFrame) -> DataFrame:
    return find(docs, train(docs)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_added"
    )
