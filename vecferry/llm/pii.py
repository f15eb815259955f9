"""Personal data: fixed rules, and a skip-chain conditional random field that adds what the rules miss.

The rules find e-mail addresses, IPv4 addresses, card and phone numbers; what they find stays. The field labels the other
tokens that hold a digit or an at sign, and groups of digits that blanks, brackets, dots or hyphens join. Its nodes are the
spans of the rules, whose labels are given, and those tokens. Neighbours in the text share a chain potential; tokens
anywhere in the document that are equal but for their writing (the same address, the same last seven digits) share a
skip potential with the one before and with the rules' span of that name, so that a number named once in full is found
again where it is written otherwise. Loopy belief propagation with damped messages gives each token's marginals.

Training is piecewise, on at most ``train_rows`` documents, those with the lowest hash of ``doc_id``, and at most
``train_tokens`` tokens of them. What the rules find there is written anew in other forms, in copies of its surroundings
that are appended to the text, and labelled with its kind. Beside one copy of each stands another with other digits, which nothing
names: it is labelled none, like all other tokens, so that the form of a number alone does not decide. A softmax regression on the
shape of a token and the words around it gives the node potentials; counts of pairs that agree and that don't give those of
both kinds of edges.

For scale: a document is one row and its graph is built where it is read; the number of edges is at most twice the number
of nodes. One pass, no shuffle; the model is of fixed size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vecferry.llm.common import texts, written

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
PLACES = 1 << 12
NEAR = 24  # characters between neighbours on the chain
SURE = 0.95
ROUNDS = 12

BLANK = re.compile(r"[\x20\x09-\x0D]")
HINT = re.compile(r"[0-9@]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")  # a match that starts within a run of digits starts before it too
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
EDGE = " \t\n\x0b\x0c\r.,;:!?()[]{}<>\"'"
QUAD = re.compile(r"([0-9]{1,3})[.:_-]([0-9]{1,3})[.:_-]([0-9]{1,3})[.:_-]([0-9]{1,3})")
AT = re.compile(r"\(at\)|\[at\]|\{at\}", re.I)
GROUPS = re.compile(r"\(?[0-9]+\)?(?:[ .-][0-9]+|[ .-]?\([0-9]+\)|(?<=\))[0-9]+)+")  # digits in groups
AROUND = 40  # characters of a span's surroundings that its copies are written in

Span = tuple[str, int, int]


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """What the rules find, by kind and start."""
    out: list[Span] = []
    if "@" in text:
        after = 0
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > after and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                out.append(("email", start, m.end()))
                after = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def tokens(text: str) -> list[tuple[int, int]]:
    """Places of the words with a digit or an at sign, without marks at their ends."""
    out, at = [], 0
    for m in HINT.finditer(text):
        if m.start() < at:
            continue
        start = m.start()
        while start > at and not BLANK.match(text[start - 1]):
            start -= 1
        stop = BLANK.search(text, m.end())
        at = stop.start() if stop else len(text)
        word = text[start:at]
        left = len(word) - len(word.lstrip(EDGE))
        if word.strip(EDGE):
            out.append((start + left, start + len(word.rstrip(EDGE))))
    return out


def groups(text: str) -> list[tuple[int, int]]:
    """Places of digit groups that together may be a number to call or pay with, where blanks or brackets join them."""
    found = [m.span() for m in GROUPS.finditer(text) if " " in m[0] or "(" in m[0]]
    return [(s, e) for s, e in found if 7 <= len(digits(text[s:e])) <= 19]


def skip_key(token: str) -> str | None:
    """Tokens with the same key name the same thing, written alike or not."""
    quad = QUAD.fullmatch(token)
    if quad:
        return "ip:" + ".".join(str(int(q)) for q in quad.groups())
    token = AT.sub("@", token)
    if "@" in token:
        return "@:" + token.lower()
    number = digits(token)
    return f"7:{number[-7:]}" if len(number) >= 7 and not any(c.isalpha() for c in token) else None


def allowed(token: str) -> list[bool]:
    """Which labels a token that the rules left can have."""
    number, letters = digits(token), any(c.isalpha() for c in token)
    quad = QUAD.fullmatch(token)
    return [
        True, "@" in AT.sub("@", token).strip("@"), bool(quad) and all(int(q) <= 255 for q in quad.groups()),
        not letters and 13 <= len(number) <= 19 and luhn(number), not letters and 7 <= len(number) <= 15]


def features(token: str, before: str, after: str) -> list[int]:
    """Places of a token's features: its shape, its coarse shape, its number of digits, checks of them, the words around it."""
    shape = "".join("9" if "0" <= c <= "9" else "a" if c.islower() else "A" if c.isupper() else c for c in token)
    coarse = re.sub(r"(.)\1+", r"\1", shape)
    number = digits(token)
    found = [
        f"s{shape}", f"c{coarse}", f"n{min(len(number), 20)}", f"l{13 <= len(number) <= 19 and luhn(number)}", f"@{'@' in token}", "1",
        f"b{before}", f"a{after}"]
    return [crc32(x.encode("utf-8", "surrogatepass")) % PLACES for x in found]


def described(text: str, start: int, end: int) -> list[int]:
    """The features of a place: of the words around it those within ``AROUND`` characters."""
    before, after = text[max(0, start - AROUND) : start].split(), text[end : end + AROUND].split()
    return features(text[start:end], before[-1].strip(EDGE).lower() if before else "", after[0].strip(EDGE).lower() if after else "")


@dataclass(frozen=True)
class Field:
    """Node weights by feature and label, and the potentials of agreeing on the chain and on skip edges."""

    weights: np.ndarray
    chain: float
    skip: float


def graph(text: str, spans: list[Span]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]], list[tuple[int, int]]]:
    """(nodes, chain edges, skip edges): nodes are (start, end, label), label 0 for tokens that the rules left."""
    taken = sorted((s, e) for _, s, e in spans)
    nodes = [(s, e, LABELS.index(k)) for k, s, e in spans]
    for found in (groups(text), tokens(text)):  # a word inside of digit groups is no node of its own
        at, held = 0, []
        for start, end in found:
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if at == len(taken) or taken[at][0] >= end:
                held.append((start, end))
        nodes += [(s, e, 0) for s, e in held]
        taken = sorted(taken + held)
    nodes.sort()
    chain = [(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1][0] - nodes[i][1] <= NEAR]
    keys = [skip_key(text[start:end].strip(EDGE)) for start, end, _ in nodes]
    named: dict[str, int] = {}
    for i, (key, node) in enumerate(zip(keys, nodes, strict=True)):
        if key is not None and node[2]:
            named.setdefault(key, i)
    last: dict[str, int] = {}
    skip = []
    for i, key in enumerate(keys):
        if key is not None:
            ends = {last.get(key, i), named.get(key, i)} - {i}
            skip += [(min(i, j), max(i, j)) for j in sorted(ends)]
            last[key] = i
    return nodes, chain, sorted(set(skip))


def propagate(unary: np.ndarray, edges: np.ndarray, strength: np.ndarray) -> np.ndarray:
    """Marginals of a field with agreement potentials, by damped loopy belief propagation; all messages at once."""
    n, k = unary.shape
    if not len(edges):
        shifted = np.exp(unary - unary.max(1, keepdims=True))
        return shifted / shifted.sum(1, keepdims=True)
    of = np.concatenate([edges[:, 0], edges[:, 1]])
    to = np.concatenate([edges[:, 1], edges[:, 0]])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    gain = np.expm1(np.concatenate([strength, strength]))[:, None]
    message = np.zeros((len(of), k))

    def belief() -> np.ndarray:
        total = unary.copy()
        np.add.at(total, to, message)
        return total

    for _ in range(ROUNDS):
        out = belief()[of] - message[back]
        out = np.exp(out - out.max(1, keepdims=True))
        new = np.log(out.sum(1, keepdims=True) + gain * out)
        message = 0.5 * message + 0.5 * (new - new.max(1, keepdims=True))
    total = belief()
    total = np.exp(total - total.max(1, keepdims=True))
    return total / total.sum(1, keepdims=True)


def added_spans(text: str, spans: list[Span], field: Field) -> list[Span]:
    """Tokens that the field labels with a probability of at least ``SURE``."""
    nodes, chain, skip = graph(text, spans)
    free = [i for i, node in enumerate(nodes) if not node[2]]
    if not free:
        return []
    unary = np.full((len(nodes), len(LABELS)), -40.0)
    for i, (start, end, label) in enumerate(nodes):
        if label:
            unary[i, label] = 0.0
        else:
            unary[i] = np.where(allowed(text[start:end]), field.weights[described(text, start, end)].sum(0), -40.0)
    edges = np.array(chain + skip, np.int64).reshape(-1, 2)
    strength = np.array([field.chain] * len(chain) + [field.skip] * len(skip))
    marginal = propagate(unary, edges, strength)
    return [(LABELS[j], nodes[i][0], nodes[i][1]) for i in free if (j := int(marginal[i].argmax())) and marginal[i, j] >= SURE]


def rewritten(kind: str, token: str) -> list[str]:
    """Other ways to write what the rules have found."""
    number = digits(token)
    if kind == "email":
        return [token.replace("@", at) for at in ("(at)", "[at]")]
    if kind == "ip":
        return [token.replace(".", mark) for mark in "-_:"]
    if kind == "card":
        fours = [number[i : i + 4] for i in range(0, len(number), 4)]
        return [".".join(fours)]
    area, middle, rest = number[-10:-7], number[-7:-4], number[-4:]
    return [f"{area}-{middle}-{rest}", f"({area}) {middle}-{rest}", f"{area}.{middle}.{rest}", f"{area} {middle} {rest}"] if area else [f"{middle}-{rest}"]


def decoy(kind: str, form: str) -> str | None:
    """The same form with other digits; of an address in words there is none, its form says what it is."""
    if kind == "email":
        return None
    if kind == "ip":
        return re.sub("[0-9]+", lambda m: str((int(m[0]) + 37) % 256), form)
    return "".join(str((int(c) + 3 + i) % 10) if "0" <= c <= "9" else c for i, c in enumerate(form))


def training_text(text: str, spans: list[Span]) -> tuple[str, dict[tuple[int, int], int]]:
    """The text with its spans written anew at the end, each in a copy of its surroundings; places and labels of the copies."""
    parts, at, labels = [text], len(text), {}
    for kind, start, end in spans:
        before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
        forms = rewritten(kind, text[start:end])
        chosen = forms[crc32(text[start:end].encode()) % len(forms)]
        for form in forms:
            place = at + 2 + len(before)
            labels[place, place + len(form)] = LABELS.index(kind)
            parts.append(f"\n\n{before}{form}{after}")
            other = decoy(kind, form) if form == chosen else None
            if other:
                parts.append(f"\n\n{before}{other}{after}")
            at += sum(map(len, parts[-2 if other else -1 :]))
    return "".join(parts), labels


def fit(documents: DataFrame, train_rows: int = 2000, train_tokens: int = 20_000) -> Field:
    """The field, fitted on rows that the rules label; an empty table gives one that adds nothing by itself."""
    picked = documents.select(F.col("doc_id").cast("long").alias("_id")).filter("_id is not null").distinct()
    picked = picked.orderBy(F.xxhash64("_id"), "_id").limit(train_rows)  # a bounded sample, see above
    sample = texts(documents).join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not HINT.search(text):
                    continue
                whole, labels = training_text(text, base_spans(text))
                nodes, chain, skip = graph(whole, base_spans(whole))
                label = [known or labels.get((s, e), 0) for s, e, known in nodes]
                near, far = [[0, 0] for _ in nodes], [[0, 0] for _ in nodes]
                for pairs, of in ((chain, near), (skip, far)):
                    for i, j in pairs:
                        of[j][label[i] == label[j]] += 1
                rows += [(doc_id, s, label[i], described(whole, s, e), near[i], far[i]) for i, (s, e, _) in enumerate(nodes)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.int32())] * 3]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "start", "label", "features", "near", "far"])

    found = written(sample.mapInArrow(run, "doc_id long, start int, label int, features array<int>, near array<int>, far array<int>"), "labelled-tokens")
    agree = found.agg(*[F.coalesce(F.sum(F.element_at(c, at)), F.lit(0)) for c in ("near", "far") for at in (2, 1)]).first()
    chain, skip = (float(np.log(a + 1.0) - np.log(b + 1.0)) for a, b in (agree[:2], agree[2:]))
    rows = found.select("label", "features", "doc_id", "start").orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start").limit(train_tokens).collect()
    return Field(_softmax(rows), max(0.0, chain), max(0.0, skip))


def _softmax(rows: list, rounds: int = 200, rate: float = 0.5, ridge: float = 1e-4) -> np.ndarray:
    """Weights (feature, label) of a softmax regression, by full gradients with Adagrad."""
    w = np.zeros((PLACES, len(LABELS)))
    if not rows:
        w[features("", "", "")[5], 0] = 40.0
        return w
    x = np.array([r[1] for r in rows])
    y = np.eye(len(LABELS))[[r[0] for r in rows]]
    seen = np.full_like(w, 1e-8)
    for _ in range(rounds):
        scores = w[x].sum(1)
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = ridge * w
        for column in range(x.shape[1]):
            np.add.at(g, x[:, column], (p - y) / len(rows))
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w


def find_pii(documents: DataFrame, field: Field) -> DataFrame:
    """A row per document: ``doc_id, base, added``, arrays of (kind, start, end) by kind and start.

    Places are code points, ends exclusive. Null and empty texts have no spans; very long ones are read whole, in linear time. Repeated rows get the same spans. An empty
    table gives no rows.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def order(s: Span) -> tuple[int, int]:
        return KINDS.index(s[0]), s[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, added = [], []
            for text in batch.column("text").to_pylist():
                found, more = [], []
                if HINT.search(text):
                    found = base_spans(text)
                    more = sorted(added_spans(text, found, field), key=order)
                base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in found])
                added.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in more])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, span), pa.array(added, span)], names=["doc_id", "base", "added"])

    kinds = "array<struct<kind: string, start: int, end: int>>"
    return texts(documents).mapInArrow(run, f"doc_id long, base {kinds}, added {kinds}")


def digest(found: DataFrame) -> DataFrame:
    """``doc_id``, base counts by kind, ``base_sha256`` and all ``spans`` as text, by kind and start."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(spans, kind):
        return F.filter(spans, lambda s: s["kind"] == kind)

    parts = [F.array_sort(of(F.concat("base", "added"), k)) for k in KINDS]
    counts = [F.size(of("base", k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(text(F.col("base")).cast("binary"), 256).alias("base_sha256"), text(F.concat(*parts)).alias("spans"))
