"""Personal data by weak supervision.

Fixed rules give base spans, which always stay.  Wider patterns give further
candidates.  Four labelers vote on every candidate: the fixed rule, a
gazetteer (top-level domains, card issuers, country codes, address ranges),
the words before it, and the characters around it.  Expectation maximisation
over the vote patterns estimates how far each labeler can be trusted and how
likely each pattern is right; those likelihoods train the final classifier,
which sees the shape of a span as well and decides on the candidates that are
not base spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256
from ipaddress import IPv6Address
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chaffsieve.llm.tables import small_batches, whole_text
from chaffsieve.sources.staging import stage

KINDS = ("email", "ip", "card", "phone")
# Candidates the final classifier is trained on, about; a larger set is thinned by hash.
SAMPLE = 20_000
ACCEPT = 0.9
NO, ABSTAIN, YES = 0, 1, 2
# The fixed rule: chance of no, abstain and yes for a wrong and for a right span.
RULE = np.array([[0.6, 0.3, 0.1], [0.01, 0.3, 0.69]])

# Characters of the local part of an address, and its domain.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits matches from its first digit or not at all, so no other start is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

# Wider patterns.
_AT = re.compile(r"\(at\)|\[at\]|\{at\}| at ", re.I)
_BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]{2,64} ?$")
_AFTER_AT = re.compile(
    r" ?[A-Za-z0-9-]{1,64}(?: ?(?:\(dot\)|\[dot\]|\{dot\}| dot |\.) ?[A-Za-z0-9-]{2,24})+", re.I
)
_IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?=[0-9A-Fa-f]*:)[0-9A-Fa-f:]{2,39}(?![0-9A-Za-z:])")
# Three groups as in North America, or a trunk zero and groups, as in most of Europe.
_NATIONAL = re.compile(
    r"(?<![0-9+])(?:\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|\(?0[1-9][0-9]{0,4}\)?(?:[ /.-][0-9]{2,8}){1,5})(?![0-9])"
)

# Gazetteers and context words.
TOP_LEVEL = frozenset(
    """com org net edu gov mil int info biz name io co ai app dev me tv us uk de fr es it nl be ch
    at pl se no fi dk ie pt gr cz hu ro bg hr sk si lt lv ee eu ru ua tr il ae in cn jp kr tw hk sg
    my th vn id ph au nz ca mx br ar cl pe ve za ng ke eg example test""".split()
)
COUNTRY_CODES = frozenset(
    """1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63
    64 65 66 81 82 84 86 90 91 92 93 94 95 98 212 213 216 218 351 352 353 354 355 356 357 358 359 370
    371 372 373 374 375 380 381 385 386 387 389 420 421 852 880 886 961 962 963 964 965 966 971
    972 973 974 977""".split()
)
FOR = {
    "email": frozenset("email e-mail mail mailto contact write correo courriel adresse address".split()),
    "ip": frozenset("ip ipv4 ipv6 host server address addr from login client adresse".split()),
    "card": frozenset("card credit visa mastercard amex payment pay karte tarjeta carte".split()),
    "phone": frozenset(
        "call phone tel telephone mobile cell fax dial text telefon tél teléfono contact at".split()
    ),
}
AGAINST = frozenset(
    "version v ver release isbn issn order invoice section chapter id no nr serial build doi part".split()
)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost start is the first local character before an @, after the last match."""
    done, at = 0, text.find("@")
    while at != -1:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(start, kind number, end, whether it passes) of the fixed patterns, kind by kind."""
    for start, end in _emails(text):
        yield start, 0, end, True
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            yield m.start(), 1, m.end(), all(map(_small, m[0].split(".")))
        for m in _CARD.finditer(text):
            digits = _digits(m[0]) if m.end() - m.start() < 64 else ""
            if 12 <= len(digits) <= 19:
                yield m.start(), 2, m.end(), _luhn(digits)
        if "+" in text:
            for m in _PHONE.finditer(text):
                yield m.start(), 3, m.end(), 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in code points, by start and then kind."""
    return sorted((s, k, e) for s, k, e, ok in matches(text) if ok)


def _wider(text: str) -> Iterator[tuple[int, int, int]]:
    for m in _AT.finditer(text):
        window = text[max(0, m.start() - 66) : m.start()]
        before, after = _BEFORE_AT.search(window), _AFTER_AT.match(text[m.end() : m.end() + 200])
        # The bare word "at" is everywhere: there the dot must be spelled out, too.
        if before and after and (m[0] != " at " or "dot" in after[0].lower()):
            yield m.start() - len(before[0]), 0, m.end() + after.end()
    if _DIGIT.search(text):
        for m in _NATIONAL.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 13:
                yield m.start(), 3, m.end()
    if ":" in text:
        for m in _IPV6.finditer(text):
            if m[0].count(":") >= 2 and _DIGIT.search(m[0]) and _is_ipv6(m[0]):
                yield m.start(), 1, m.end()


def _is_ipv6(text: str) -> bool:
    try:
        IPv6Address(text)
    except ValueError:
        return False
    return True


def _gazetteer(kind: int, span: str) -> int:
    digits = _digits(span)
    if kind == 0:
        return YES if re.split(r"[^A-Za-z0-9]+", span.lower().rstrip(")]}"))[-1] in TOP_LEVEL else NO
    if kind == 1:
        if ":" in span:
            # Addresses in use: global unicast, unique local, link local.
            return YES if span.count(":") == 7 or re.match("2[0-9a-f]{3}:|3[0-9a-f]{3}:|f[cd][0-9a-f]{2}:|fe80:", span.lower()) else NO
        parts = span.split(".")
        plain = all(p == "0" or not p.startswith("0") for p in parts)
        return YES if plain and all(map(_small, parts)) and 0 < int(parts[0]) < 224 else NO
    if kind == 2:
        issuer = digits[0] in "456" or digits[:2] in ("34", "35", "36", "37", "38") or "2221" <= digits[:4] <= "2720"
        return YES if issuer and 13 <= len(digits) <= 19 else NO
    if span.startswith("+"):
        return YES if any(digits[:n] in COUNTRY_CODES for n in (1, 2, 3)) else NO
    if digits[0] == "0":
        return YES if 9 <= len(digits) <= 12 else ABSTAIN  # with the trunk zero
    return YES if digits[0] != "1" else NO


def votes(text: str, start: int, kind: int, end: int, passes: bool | None) -> list[int]:
    """What each labeler says of a candidate; ``passes`` is None where no fixed rule applies."""
    rule = ABSTAIN if passes is None else YES if passes else NO
    words = re.findall(r"[^\W\d_](?:[^\W\d_]|-)*", text[max(0, start - 40) : start].lower())[-3:]
    context = ABSTAIN
    if any(w in FOR[KINDS[kind]] for w in words):
        context = YES
    elif words and words[-1] in AGAINST:
        context = NO
    before, after = text[start - 1 : start], text[end : end + 1]
    glued = before.isalnum() or after.isalnum() or before in tuple("_=/#$") or after in tuple("_=/%@")
    follows = after in (".", ",", "-") and text[end + 1 : end + 2].isdigit()
    return [rule, _gazetteer(kind, text[start:end]), context, NO if glued or follows else YES]


def shape(span: str, kind: int, cast: list[int]) -> list[float]:
    """Features of the final classifier: kind, votes, and the span's make-up.

    Of the rule only its refusal counts, so that candidates of the wider
    patterns, on which it has no say, can be told from what the others see.
    """
    n = max(1, len(span))
    row = [0.0] * 14
    row[kind] = 1.0
    row[4] = float(cast[0] == NO)
    for i, v in enumerate(cast[1:]):
        row[5 + 3 * i + v] = 1.0
    digits = sum(c.isdigit() for c in span)
    other = sum(not c.isalnum() for c in span)
    return [*row, min(n, 40) / 40, digits / n, other / n, float(span[:1] in "+("), 1.0]


@dataclass(frozen=True)
class Model:
    """Reliabilities per kind and labeler, and the final classifier."""

    reliability: dict[int, np.ndarray] = field(default_factory=dict)  # [labeler, truth, vote]
    prior: dict[int, float] = field(default_factory=dict)
    weights: np.ndarray | None = None

    def probability(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(rows))
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights, -50, 50)))


def reliabilities(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 50
) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation maximisation over vote patterns: (prior, [labeler, truth, vote], P(true) per pattern).

    Votes are independent given the truth.  It starts from the majority, and
    every vote keeps a little probability, so one labeler never decides alone.
    How far the fixed rule is right is known and not estimated: a number whose
    checksum fails is hardly ever a card, however card-like it looks.
    """
    truth = np.clip(0.5 + 0.2 * (patterns - 1).sum(axis=1), 0.05, 0.95)
    one_hot = np.eye(3)[patterns]  # [pattern, labeler, vote]
    for _ in range(rounds):
        weight = np.stack([counts * (1 - truth), counts * truth])
        table = np.einsum("tp,plv->ltv", weight, one_hot) + 0.5
        table /= table.sum(axis=2, keepdims=True)
        table[0] = RULE
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        logs = np.einsum("plv,ltv->pt", one_hot, np.log(table))
        odds = logs[:, 1] - logs[:, 0] + np.log(prior / (1 - prior))
        truth = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return float(prior), table, truth


def _train(
    rows: np.ndarray, target: np.ndarray, times: np.ndarray, rounds: int = 400, rate: float = 2.0
) -> np.ndarray:
    """Logistic regression on probabilistic labels, by gradient descent with a small ridge.

    Row i counts ``times[i]`` times.
    """
    weights, share = np.zeros(rows.shape[1]), times / times.sum()
    for _ in range(rounds):
        found = 1 / (1 + np.exp(-np.clip(rows @ weights, -50, 50)))
        weights -= rate * (rows.T @ (share * (found - target)) + 1e-4 * weights)
    return weights


CANDIDATE = "struct<start: bigint, kind: int, end: bigint, base: boolean, votes: array<int>, shape: array<double>>"
_CANDIDATES = pa.list_(
    pa.struct(
        [
            ("start", pa.int64()),
            ("kind", pa.int32()),
            ("end", pa.int64()),
            ("base", pa.bool_()),
            ("votes", pa.list_(pa.int32())),
            ("shape", pa.list_(pa.float64())),
        ]
    )
)


def _found(text: str) -> list[dict]:
    tried = sorted(matches(text))
    # Starts of the base spans in order, and how far all up to each of them reach.
    starts = [s for s, _, _, ok in tried if ok]
    reach = list(accumulate((e for _, _, e, ok in tried if ok), max))
    every = [(s, k, e, ok) for s, k, e, ok in tried]
    every += [(s, k, e, None) for s, k, e in _wider(text)]
    out = []
    for s, k, e, ok in every:
        # What overlaps a base span is no candidate of its own.
        before = bisect_left(starts, e)
        if not ok and before and reach[before - 1] > s:
            continue
        cast = votes(text, s, k, e, ok)
        out.append(
            {"start": s, "kind": k, "end": e, "base": bool(ok), "votes": cast, "shape": shape(text[s:e], k, cast)}
        )
    return out


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, found) per row: every candidate span with its votes and features."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_found(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, _CANDIDATES)], names=["doc_id", "found"]
            )

    return docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")).mapInArrow(
        run, f"doc_id bigint, found array<{CANDIDATE}>"
    )


def fit(found: DataFrame, sample: int = SAMPLE) -> Model:
    """Reliabilities from the vote patterns of all candidates, then the final classifier.

    There are at most 4 * 81 patterns; they and about ``sample`` different
    shapes of candidates reach the driver, each with its number.
    """
    spans = found.select(F.explode("found").alias("c")).select("c.*")
    tally = spans.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()
    prior, table, truth = {}, {}, {}
    for kind in sorted({r["kind"] for r in tally}):
        rows = sorted((tuple(r["votes"]), r["n"]) for r in tally if r["kind"] == kind)
        patterns, counts = np.array([v for v, _ in rows]), np.array([n for _, n in rows], float)
        prior[kind], table[kind], likely = reliabilities(patterns, counts)
        truth |= {(kind, v): p for (v, _), p in zip(rows, likely)}
    if not tally:
        return Model()
    # Equal shapes are one row with their number, so copies of a document cost nothing.
    shapes = stage(spans.groupBy("kind", "votes", "shape").agg(F.count("*").alias("n")), "pii-shapes")
    kept = min(1.0, sample / shapes.count())
    draw = F.shiftrightunsigned(F.xxhash64("kind", "votes", "shape"), 4).cast("double") / float(1 << 60)
    picked = sorted(shapes.filter(draw < kept).collect(), key=lambda r: (r["kind"], r["votes"], r["shape"]))
    if not picked:
        return Model(table, prior, None)
    rows = np.array([r["shape"] for r in picked])
    target = np.array([truth[r["kind"], tuple(r["votes"])] for r in picked])
    return Model(table, prior, _train(rows, target, np.array([r["n"] for r in picked], float)))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, added.

    The counts and the digest are of the base spans; ``spans`` lists all as
    kind:start:end in code points, by start and then kind, ``added`` says how
    many the classifier added.  Added spans never overlap base spans.  A NULL
    or empty text has none.  Rows are judged one by one, so repeats agree; an
    empty table gives no rows.  Candidates are staged, a few numbers per span,
    so texts are read once.
    """
    found = stage(candidates(docs), "pii-candidates")
    shared = docs.sparkSession.sparkContext.broadcast(fit(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            counts, digests, spans, added = [], [], [], []
            for row in batch.column("found").to_pylist():
                base = [(c["start"], c["kind"], c["end"]) for c in row if c["base"]]
                open_ = [c for c in row if not c["base"]]
                extra: list[tuple[int, int, int]] = []  # disjoint, by start
                if open_:
                    chance = model.probability(np.array([c["shape"] for c in open_]))
                    for p, c in sorted(zip(chance, open_), key=lambda x: (-x[0], x[1]["start"], x[1]["kind"])):
                        s, e = c["start"], c["end"]
                        at = bisect_left(extra, (e,))
                        if p >= ACCEPT and not (at and extra[at - 1][2] > s):
                            extra.insert(at, (s, c["kind"], e))
                counts.append([sum(k == kind for _, k, _ in base) for kind in range(4)])
                digests.append(sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(base + extra))
                added.append(len(extra))
            columns = np.array(counts, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *map(pa.array, columns),
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()),
                    pa.array(added, pa.int64()),
                ],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "added"],
            )

    return found.mapInArrow(
        run,
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string, added bigint",
    )
