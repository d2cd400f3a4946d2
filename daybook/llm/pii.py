"""Personal data by weak supervision.

The base patterns give spans that are always kept. Wider patterns propose
further ones: parts of base matches that failed as a whole (two card numbers
side by side), written-out or masked forms (``name [at] host [dot] tld``),
national phone numbers, long addresses. On every candidate a few labelers
vote for, against or not at all: the regex, the format with its checksum, a
gazetteer, the words before it, its edges, and the company it keeps in its
document. Expectation-maximisation over the counts of all vote patterns of the
corpus estimates how reliable each labeler is; the resulting probabilities
train a logistic classifier per kind, which decides the proposed spans.

Texts are read once. Votes and features are a few small numbers, so what the
driver sees is one count for each pattern of them, at most 4 * 3**6 * 2**7
(far fewer occur).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import written

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LABELERS = ("regex", "format", "gazetteer", "context", "edges", "company")
FEATURES = ("spaced before", "ends clean", "capitals around", "separators", "same line digits", "masked", "part of a match")

# base patterns; possessive runs, so that long ones stay linear
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# wider patterns
_AT = re.compile(r"\s?[\[({<]\s?(?:at|AT|At)\s?[\])}>]\s?| at | AT | ?[@＠] ?")
_DOTS = re.compile(r"[A-Za-z0-9-]{1,63}+(?:(?:\s?[\[({<]\s?(?:dot|DOT|Dot|\.)\s?[\])}>]\s?| dot | DOT |\.)[A-Za-z0-9-]{1,63}+)+")
_MASKED_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?| dot |\.)[0-9]{1,3}"
                        r"(?:(?:\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?| dot |\.)[0-9]{1,3}){2}(?![0-9])")
_LONG_IP = re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_CARD_PART = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ . -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?"
                        r"|[0-9]{4}([ . -])[0-9]{6}\2[0-9]{5})(?![0-9])")
_PHONE_PART = re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?[0-9]{2,4}[ .-][0-9]{3,4}|[0-9]{2,4}(?:[ .-][0-9]{2,4}){2,4})(?![0-9])"
                         r"|(?<![0-9+)(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}(?![0-9])"
                         r"|(?<![0-9])00[1-9][0-9]{0,2}[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])")

# Common top-level domains, calling codes, first digits of card issuers, words before data.
_TOP_LEVEL = frozenset("com org net edu gov mil int info biz io co ai app dev eu de fr es it nl be at ch pt pl se no dk fi ie uk us ca "
                       "mx br ar cl au nz jp cn kr in ru ua cz sk hu ro bg gr tr il za example test".split())
_CALLING = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
                 "90 91 92 93 94 95 98 212 213 216 218 351 352 353 354 358 359 370 371 372 380 385 386 420 421 852 886 971 972".split())
_ISSUERS = re.compile(r"4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|30[0-5]|36|38|39|35(?:2[89]|[3-8])|6(?:011|4[4-9]|5)|62|50|5[6-9]|6")
_CLUES = {
    EMAIL: re.compile(r"e-?mail|contact|write|reach|correo|kontakt|courriel|adresse|\bcc\b|\bto\b", re.I),
    IP: re.compile(r"\bip\b|host|server|address|login|client|from|adresse", re.I),
    CARD: re.compile(r"card|visa|master|amex|credit|debit|payment|tarjeta|karte|carte|\bcc\b|paid", re.I),
    PHONE: re.compile(r"phone|tel|call|mobile|cell|fax|whatsapp|\bsms\b|llam|ruf|appel|contact", re.I),
}
_AGAINST = re.compile(r"version|\bv\.?$|release|isbn|issn|doi|serial|order|invoice|section|figure|token|hash|commit|license|\bid\b|build|sku", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _only(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(kind, start, end) of the base patterns, sorted, and of the matches
    that failed their check."""
    spans, failed = [], []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            spans.append((EMAIL, start, end))
        at = text.find("@", max(at + 1, end))
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        if len(parts) < 4:
            continue
        start = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            good = all(len(x.lstrip("0")) < 4 and int(x) < 256 for x in four)
            (spans if good else failed).append((IP, start, end))
            start = end + 1
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _only(m.group())
            if len(digits) >= 13:
                (spans if len(digits) <= 19 and luhn(digits) else failed).append((CARD, *m.span()))
    if "+" in text:
        for m in _DIALLED.finditer(text):
            (spans if 9 <= len(_only(m.group())) <= 15 else failed).append((PHONE, *m.span()))
    return sorted(spans), failed


def proposals(text: str, failed: list[tuple[int, int, int]]) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, part of a failed match) that wider patterns find."""
    out = []
    for m in _AT.finditer(text):
        host = _DOTS.match(text, m.end())
        start = m.start()
        while start > max(0, m.start() - 64) and text[start - 1] in _LOCAL:
            start -= 1
        if host and start < m.start():
            out.append((EMAIL, start, host.end(), False))
    if any(c in text for c in "0123456789"):
        for pattern, kind in ((_MASKED_IP, IP), (_LONG_IP, IP), (_CARD_PART, CARD), (_PHONE_PART, PHONE)):
            for m in pattern.finditer(text):
                if not (kind == IP and m.group().count(".") == 3 and _DOTTED.fullmatch(m.group())):
                    out.append((kind, *m.span(), False))
    within = {}
    for kind, lo, hi in failed:
        within.setdefault(kind, []).append((lo, hi))
    for spans in within.values():
        spans.sort()
    starts = {k: np.array([s[0] for s in v]) for k, v in within.items()}

    def part(kind: int, lo: int, hi: int) -> bool:
        if kind not in starts:
            return False
        i = int(np.searchsorted(starts[kind], lo, side="right")) - 1
        return i >= 0 and hi <= within[kind][i][1]

    return [(k, lo, hi, part(k, lo, hi)) for k, lo, hi, _ in out]


def votes_of(text: str, kind: int, lo: int, hi: int, base: bool, company: bool) -> list[int]:
    """1 for, 0 against, 2 none, of each labeler."""
    span = text[lo:hi]
    digits = _only(span)
    before = text[max(0, lo - 40):lo]
    regex = 1 if base else 2
    if kind == EMAIL:
        tail = re.split(r"[^A-Za-z0-9]+", span.rstrip(")]}>"))[-1].lower()
        fits, known = len(tail) >= 2 and tail.isalpha(), tail in _TOP_LEVEL
        if " at " in span.lower():  # a common word: the dots must be written out too
            fits = fits and known and " dot " in span.lower()
    elif kind == IP:
        parts = re.findall(r"[0-9]+", span) if ":" not in span else []
        fits = ":" in span or all(int(x[-4:]) < 256 for x in parts)
        known = ":" in span or 0 < int(parts[0][-4:]) < 224
    elif kind == CARD:
        fits, known = 13 <= len(digits) <= 19 and luhn(digits), bool(_ISSUERS.match(digits)) and len(set(digits)) > 2
    else:
        fits = 9 <= len(digits) <= 15
        code = digits[2:] if span.startswith("00") else digits
        known = code.startswith(_CALLING) if span.startswith(("+", "00")) else 2
    context = 0 if _AGAINST.search(before[-14:]) else 1 if _CLUES[kind].search(before) else 2
    left, right = text[lo - 1:lo], text[hi:hi + 1]
    edges = 0 if left.isalnum() or right.isalnum() or left in '"=_/\\' and left or right in '"=_/\\' and right else 1
    return [regex, int(fits), int(known), context, edges, 1 if company else 2]


def features_of(text: str, kind: int, lo: int, hi: int, part: bool) -> int:
    span = text[lo:hi]
    around = text[max(0, lo - 12):lo] + text[hi:hi + 12]
    flags = [lo == 0 or text[lo - 1].isspace(), hi == len(text) or text[hi].isspace() or text[hi] in ".,;:!?)",
             around.upper() == around and any(c.isalpha() for c in around),
             any(c in " -(). " for c in span), any("0" <= c <= "9" for c in around),
             bool(re.search(r"[\[({<]| at | dot ", span)), part]
    return sum(1 << k for k, f in enumerate(flags) if f)


_FOUND = ("id long, n_email long, n_ip long, n_card long, n_phone long, base string, kind array<int>, start array<int>, "
          "stop array<int>, own array<boolean>, votes array<int>, flags array<int>")


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[list] = [[] for _ in range(11)]
        for value in batch.column(1):
            text = value.as_py()
            spans, failed = base_spans(text)
            found = [(k, lo, hi, True, False) for k, lo, hi in spans]
            found += [(k, lo, hi, False, p) for k, lo, hi, p in proposals(text, failed)]
            taken = set((k, lo, hi) for k, lo, hi in spans)
            cands = [c for c in found if c[3] or c[:3] not in taken]
            votes = [sum(v * 3 ** i for i, v in enumerate(votes_of(text, k, lo, hi, own, len(spans) > own))) for k, lo, hi, own, _ in cands]
            flags = [features_of(text, k, lo, hi, p) for k, lo, hi, _, p in cands]
            row = [sum(s[0] == k for s in spans) for k in range(4)] + [joined(spans)]
            row += [[c[i] for c in cands] for i in range(4)] + [votes, flags]
            for out, x in zip(rows, row):
                out.append(x)
        ints = pa.list_(pa.int32())
        kinds = [pa.int64()] * 4 + [pa.string(), ints, ints, ints, pa.list_(pa.bool_()), ints, ints]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(rows, kinds))],
                                         names=[part.split(" ")[0] for part in _FOUND.split(", ")])


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{lo}:{hi}" for k, lo, hi in sorted(spans))


@dataclass
class Model:
    """Per kind: the ``share`` of candidates that are personal data, the
    ``reliability`` of labelers (labeler, truth, vote) and the weights of the
    classifier."""
    share: np.ndarray
    reliability: np.ndarray
    weights: np.ndarray

    def probability(self, kind: np.ndarray, votes: np.ndarray, flags: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((inputs(votes, flags) * self.weights[kind]).sum(axis=1), -30, 30)))


def split_votes(votes: np.ndarray) -> np.ndarray:
    return votes[:, None] // 3 ** np.arange(len(LABELERS)) % 3


def inputs(votes: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """What the classifier sees: one, the votes for and against (but the base
    regex's, which no proposed span has), the features."""
    v = split_votes(votes)[:, 1:]
    f = flags[:, None] >> np.arange(len(FEATURES)) & 1
    return np.concatenate([np.ones((len(votes), 1)), v == 1, v == 0, f], axis=1).astype(float)


#: Votes against and for counted beforehand for each labeler, of spans that are not and that are personal data.
_PRIOR = np.array([[[1.0, 2.0], [0.5, 8.0]], [[6.0, 2.0], [0.3, 8.0]], [[3.0, 2.0], [1.0, 5.0]],
                   [[3.0, 1.0], [0.5, 3.0]], [[3.0, 3.0], [0.5, 5.0]], [[1.0, 1.0], [1.0, 2.0]]])


def estimate(kind: np.ndarray, votes: np.ndarray, count: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns and their counts. Returns
    per kind the share of personal data and the reliabilities (labeler, truth,
    vote), and per pattern its probability. No vote says nothing."""
    v = split_votes(votes)
    share, reliability = np.full(4, 0.5), np.empty((4, len(LABELERS), 2, 2))
    reliability[:] = _PRIOR / _PRIOR.sum(axis=2, keepdims=True)
    likely = np.full(len(votes), 0.5)
    for _ in range(rounds):
        logs = np.concatenate([np.log(reliability), np.zeros((4, len(LABELERS), 2, 1))], axis=3)
        score = np.log(share[kind]) - np.log(1 - share[kind])
        for j in range(len(LABELERS)):
            score = score + logs[kind, j, 1, v[:, j]] - logs[kind, j, 0, v[:, j]]
        likely = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        for k in range(4):
            own = kind == k
            share[k] = (count[own] @ likely[own] + 1) / (count[own].sum() + 2)
            for j in range(len(LABELERS)):
                for truth, mass in enumerate((count[own] * (1 - likely[own]), count[own] * likely[own])):
                    seen = np.bincount(v[own, j], weights=mass, minlength=3)[:2] + _PRIOR[j, truth]
                    reliability[k, j, truth] = seen / seen.sum()
    return share, reliability, likely


def fit(kind: np.ndarray, votes: np.ndarray, flags: np.ndarray, count: np.ndarray) -> Model:
    """The model of patterns (kind, votes, features) with their counts."""
    share, reliability, likely = estimate(kind, votes, count)
    x = inputs(votes, flags)
    weights = np.zeros((4, x.shape[1]))
    for k in range(4):
        own = kind == k
        if not own.any():
            continue
        a, y, n = x[own], likely[own], count[own] / count[own].sum() * min(count[own].sum(), 10_000)
        w = weights[k]
        for _ in range(40):  # Newton steps, with a penalty of half the square
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            slope = a.T @ (n * (y - p)) - w
            w = w + np.linalg.solve((a * (n * p * (1 - p))[:, None]).T @ a + np.eye(len(w)), slope)
        weights[k] = w
    return Model(share, reliability, weights)


def _decide(model: Model, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        lists = {n: batch.column(names.index(n)) for n in ("kind", "start", "stop", "own", "votes", "flags")}
        flat = {n: x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for n, x in lists.items()}
        sizes = lists["kind"].value_lengths().to_numpy(zero_copy_only=False)
        p = model.probability(flat["kind"], flat["votes"], flat["flags"])
        fits = split_votes(flat["votes"])[:, 1] == 1
        good = (flat["own"] == 0) & fits & (p >= threshold)
        spans, at = [], 0
        for n in sizes.tolist():
            rows = range(at, at + n)
            at += n
            kept = [(int(flat["kind"][i]), int(flat["start"][i]), int(flat["stop"][i])) for i in rows if flat["own"][i]]
            for i in sorted((i for i in rows if good[i]), key=lambda i: (-p[i], flat["start"][i], -flat["stop"][i])):
                lo, hi = int(flat["start"][i]), int(flat["stop"][i])
                if all(hi <= s or e <= lo for _, s, e in kept):
                    kept.append((int(flat["kind"][i]), lo, hi))
            spans.append(joined(kept))
        yield pa.RecordBatch.from_arrays([*(batch.column(names.index(n)) for n in names[:6]), pa.array(spans, pa.string())],
                                         names=[*names[:6], "spans"])


def train(found: DataFrame) -> Model:
    """The model of all candidates of all documents: one count for each
    pattern of votes and features comes to the driver."""
    patterns = (found.select(F.explode(F.arrays_zip("kind", "votes", "flags")).alias("x")).select("x.*")
                .groupBy("kind", "votes", "flags").agg(F.count("*").alias("n")).collect())
    columns = [np.array([r[name] for r in patterns], dtype=np.int64) for name in ("kind", "votes", "flags", "n")]
    return fit(*columns[:3], columns[3].astype(float))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per input row: ``id``, the counts of base spans (``n_email,
    n_ip, n_card, n_phone``), ``base`` and ``spans`` (base and added ones) as
    ``kind:start:end`` in code points, joined by commas.

    An added span keeps to its format (checksum, parts, digits), has a
    probability of ``threshold`` or more and overlaps no other; likelier ones
    come first. Null texts are empty (no spans); null and repeated ids and rows
    are judged one by one; an empty table gives an empty result. Texts are read
    once, whole; memory follows the longest and its spans.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("data"))
    found = written(rows.mapInArrow(_find, _FOUND), "spans")
    model = train(found)
    return found.mapInArrow(lambda it: _decide(model, threshold, it),
                            "id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
