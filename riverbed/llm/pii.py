"""Personal data by a skip-chain conditional random field.

Plain patterns give base spans (e-mail, IP address, payment card, phone). Around them stands a
field over the document's candidates, which are the base spans and every other token with a digit
or an @ (three to six short groups of digits with a space between them are one token): a unary potential from a multinomial logistic model of the token's shape, a chain
potential between neighbours, and a skip potential between distant candidates that repeat or
resemble each other (equal digits, one's digits the end of the other's, an equal e-mail name). Loopy belief
propagation, in sweeps until the messages stay, makes the labels of a document agree. A candidate that skip
links don't join to a base span, directly or over others, stays "other", whatever else the document holds. A candidate whose most probable label isn't
"other" becomes a span of that kind. Base spans are evidence and stay as they are. So a number
that is written with its country code once and without it elsewhere is found in both places.

Candidates that repeat are linked in a chain, each to the next of its kind in the text, and two different numbers of which
one ends with the other where they first stand: the number of links follows the number of candidates, however often one repeats.

The potentials are fitted piecewise on a bounded sample of documents (SAMPLE_DOCS), with the
base spans as labels.

Special cases: a null or empty text has no spans and the digest of an empty list; repeated rows
give equal rows; of two spans with equal start the earlier kind comes first; long texts are searched whole; an empty
table gives no rows; further columns of any name are left out; without any base span in the sample the model adds nothing."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import arrow_pass, hash_order, pick

#: In the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
#: Documents with a candidate that the potentials are fitted on, at most.
SAMPLE_DOCS = 2000
#: Candidates of one of these documents that count, at most, and code points of a candidate: both bound what the driver
#: gathers for the fit, so that no document outweighs the others; every candidate takes part in the labelling.
SAMPLE_CANDIDATES, SAMPLE_CHARS = 200, 200
#: Neighbours further apart than this many code points share no chain potential.
NEAR = 40
#: Sweeps over a document's links, at most (messages that go round in circles may not settle), and those
#: after which messages move halfway only. Where they haven't settled by then, the last beliefs count.
SWEEPS, UNDAMPED = 200, 20
#: Most that the shape of a candidate counts against a label, and the pairs of equal kind that skip links
#: are taken to join before any is counted.
SURE = 4.0
PRIOR_PAIRS = 100.0
#: Digits of a number that skip links are made for, and the longest end of a number that another one may be: the
#: most digits that a card number has.
LEAST_DIGITS, MOST_DIGITS = 7, 19

_AT = re.compile("@")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NAME_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
# A match can't begin inside a run of digits: what fails from its first digit fails from any other.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GROUPS = r"(?<![0-9A-Za-z.@+-])[0-9]{2,4}(?:[\x20.-][0-9]{2,4}){2,5}(?![0-9A-Za-z@])(?![\x20.-][0-9])"
_TOKEN = re.compile(_GROUPS + r"|[^\s,;:|<>\"'()\[\]{}=]*[0-9@][^\s,;:|<>\"'()\[\]{}=]*")
_DIGITS = re.compile("[0-9]+")
_EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str):
    """All matches of the e-mail pattern, found from the @ signs: the name before a sign reaches
    back over name characters, no further than the match before."""
    done = 0
    for at in _AT.finditer(text):
        sign = at.start()
        if sign < done:
            continue
        start = sign
        while start > done and text[start - 1] in _EMAIL_CHARS:
            start -= 1
        if start < sign and (m := _EMAIL.match(text, start)):
            yield m.span()
            done = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = "".join(_DIGITS.findall(m[0])) if m.end() - m.start() >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15:
            out.append((3, *m.span()))
    return out


def shape(token: str) -> list[int]:
    """Binary features of a candidate."""
    digits = sum(map(len, _DIGITS.findall(token)))
    letters = sum(map(str.isalpha, token))
    dots, hyphens = token.count("."), token.count("-") + token.count(" ")
    return [
        1, token.count("@") == 1, "@" in token and "." in token.partition("@")[2], token[:1] == "+", dots == 3 and letters == 0,
        letters == 0, letters > digits, digits < 6, 6 <= digits < 9, 9 <= digits < 13, 13 <= digits < 20, digits >= 20,
        dots == 0, dots == 1, hyphens > 0, hyphens > 2, len(token) > 24, 13 <= digits < 20 and luhn("".join(_DIGITS.findall(token))),
    ]


N_FEATURES = len(shape(""))


@dataclass(frozen=True)
class Candidate:
    start: int
    end: int
    base: int  # the kind of the base span, or OTHER
    text: str


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[Candidate]:
    """Base spans (the first kind where two overlap) and the other tokens with a digit or an @."""
    out = [Candidate(a, b, k, text[a:b]) for k, a, b in spans]
    covered = sorted((a, b) for _, a, b in spans)
    i, reach = 0, 0
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while b > a and text[b - 1] in ".!?*#$%&-":
            b -= 1
        while i < len(covered) and covered[i][0] < b:
            reach = max(reach, covered[i][1])
            i += 1
        if a < b and reach <= a:
            out.append(Candidate(a, b, OTHER, text[a:b]))
    out.sort(key=lambda c: (c.start, c.base))
    return out


def links(cs: list[Candidate]) -> list[tuple[int, int]]:
    """Skip edges: each candidate and the next that repeats it, and once for two different numbers of which one ends with the other."""
    edges: set[tuple[int, int]] = set()
    last: dict[tuple, int] = {}
    first: dict[str, int] = {}
    for i, c in enumerate(cs):
        digits = "".join(_DIGITS.findall(c.text))
        keys = [("same", c.text.lower())]
        if "@" in c.text:
            keys.append(("name", c.text.lower().partition("@")[0]))
        elif len(digits) >= LEAST_DIGITS and not any(map(str.isalpha, c.text)):
            keys.append(("digits", digits))
            first.setdefault(digits, i)
        for key in keys:
            if key in last:
                edges.add((last[key], i))
            last[key] = i
    for digits, i in first.items():
        for n in range(LEAST_DIGITS, min(len(digits), MOST_DIGITS + 1)):
            if (j := first.get(digits[-n:])) is not None:
                edges.add((min(i, j), max(i, j)))
    return sorted(edges)


@dataclass(frozen=True)
class Field:
    """unary: features x labels; chain and skip: labels x labels (log potentials)."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def labels(self, cs: list[Candidate]) -> list[int]:
        """The most probable label of each candidate by loopy message passing (sum-product).

        Base spans are evidence. A candidate that skip links don't join to one, over others or directly, stays "other" and counts as such."""
        label = np.array([c.base for c in cs], int)
        skips = links(cs)
        root = list(range(len(cs)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        for i, j in skips:
            root[find(j)] = find(i)
        told = {find(i) for i, c in enumerate(cs) if c.base != OTHER}
        free = [i for i, c in enumerate(cs) if c.base == OTHER and find(i) in told]
        if not free:
            return label.tolist()
        at = {i: k for k, i in enumerate(free)}
        scores = np.array([shape(cs[i].text) for i in free], float) @ self.unary
        # a candidate that no pattern has found was fitted as "other": the shape alone is only so sure of it
        scores = np.maximum(scores - scores.max(1, keepdims=True), -SURE)
        near = [(i, i + 1) for i in range(len(cs) - 1) if cs[i + 1].start - cs[i].end <= NEAR]
        edges = []
        for i, j, pot in [(i, j, self.skip) for i, j in skips] + [(i, j, self.chain) for i, j in near]:
            if i in at and j in at:
                edges.append((at[i], at[j], pot))
            elif i in at:
                scores[at[i]] += pot[:, label[j]]
            elif j in at:
                scores[at[j]] += pot[label[i]]
        label[free] = beliefs(scores, edges).argmax(1)
        return label.tolist()


def beliefs(scores: np.ndarray, edges: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
    """Log beliefs after sweeps forward and backward over ``edges`` (a < b, potential) until the messages stay
    as they are: on a chain or tree in that order one sweep is exact, at linear cost."""
    belief = scores.copy()
    order = sorted(range(len(edges)), key=lambda e: edges[e][:2])
    back = sorted(range(len(edges)), key=lambda e: (-edges[e][1], -edges[e][0]))
    messages = np.zeros((2, len(edges), OTHER + 1))
    for sweep in range(SWEEPS):
        moved = 0.0
        for way, turn in ((0, order), (1, back)):
            for e in turn:
                a, b, pot = edges[e]
                if way:
                    a, b, pot = b, a, pot.T
                out = (belief[a] - messages[1 - way, e])[:, None] + pot
                top = out.max(0)
                out = top + np.log(np.exp(out - top).sum(0))
                out -= out.max()
                if sweep >= UNDAMPED:
                    out = 0.5 * (out + messages[way, e])
                step = out - messages[way, e]
                belief[b] += step
                messages[way, e] = out
                moved = max(moved, float(np.abs(step).max()))
        if moved < 1e-6:
            break
    return belief


def fit(rows: list[tuple[int, int, str, int]]) -> Field:
    """``rows``: (document, start, text, base kind or OTHER), sorted. Each piece of the field is
    fitted on its own: the unary part by gradient steps on the multinomial likelihood, the others
    from counts. For the skip part only pairs of base spans count: a candidate that no pattern
    has found isn't evidence that it is none."""
    k = OTHER + 1
    chain, skip = np.ones((k, k)), np.ones((k, k))
    unary = np.zeros((N_FEATURES, k))
    if rows:
        x = np.array([shape(t) for _, _, t, _ in rows], float)
        y = np.array([b for *_, b in rows])
        target = np.eye(k)[y]
        for _ in range(300):
            z = x @ unary
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            unary -= 1.0 * (x.T @ (p - target) / len(rows) + 1e-3 * unary)
        by_doc: dict[int, list[Candidate]] = {}
        for d, start, t, b in rows:
            by_doc.setdefault(d, []).append(Candidate(start, start + len(t), b, t))
        for cs in by_doc.values():
            for one, two in zip(cs, cs[1:]):
                if two.start - one.end <= NEAR:
                    chain[one.base, two.base] += 1
            for i, j in links(cs):
                if OTHER not in (cs[i].base, cs[j].base):
                    skip[cs[i].base, cs[j].base] += 1
    chain /= chain.sum()
    chain = np.log(chain) - np.log(chain.sum(1, keepdims=True)) - np.log(chain.sum(0, keepdims=True))
    found = skip[:OTHER, :OTHER] + skip[:OTHER, :OTHER].T
    agree = (np.diag(found) + PRIOR_PAIRS) / (found.sum(1) + PRIOR_PAIRS)
    same = np.log(agree / (1 - agree))
    out = np.zeros((k, k))
    out[np.arange(OTHER), np.arange(OTHER)] = same
    out[OTHER, OTHER] = 0.5
    return Field(unary, 0.3 * chain, 2.0 * out)


def _sample_rows(columns: dict[str, list]) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in ("*", "start", "token", "base")}
    for i, t in enumerate(columns["text"]):
        text = t or ""
        for c in candidates(text, base_spans(text))[:SAMPLE_CANDIDATES]:
            for name, value in zip(out, (i, c.start, c.text[:SAMPLE_CHARS], c.base)):
                out[name].append(value)
    return out


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    rows = pick(docs, doc_id="long", text="string")
    n = rows.count()
    lot = F.pmod(hash_order("doc_id", 5), F.lit(1 << 40))
    share = min(1.0, 20.0 * sample_docs / max(1, n))
    few = (rows.where(lot < int(share * (1 << 40))).where(F.col("text").rlike("@|[0-9]{5}|[0-9][.][0-9]"))
           .orderBy(lot, "doc_id", F.crc32(F.col("text").cast("binary"))).limit(sample_docs))
    got = arrow_pass(few, _sample_rows, "start int, token string, base int", keep=("doc_id",)).collect()
    return fit(sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["start"], r["token"], r["base"]) for r in got))


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def scan(text: str | None, model: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base and added ones, both by kind, then start."""
    text = text or ""
    base = base_spans(text)
    if not base:  # no label that a repeated or similar token could take over
        return base, base
    cs = candidates(text, base)
    added = [(k, c.start, c.end) for c, k in zip(cs, model.labels(cs)) if c.base == OTHER and k != OTHER]
    return base, sorted(base + added)


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, counts of base spans, their digest, all spans, number of added ones."""
    model = learn(docs)

    def work(columns: dict[str, list]) -> dict[str, list]:
        got = [scan(t, model) for t in columns["text"]]
        out = {f"n_{kind}": [sum(1 for s in base if s[0] == k) for base, _ in got] for k, kind in enumerate(KINDS)}
        return out | {
            "base_sha256": [hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in got],
            "spans": [listed(spans) for _, spans in got],
            "n_added": [len(spans) - len(base) for base, spans in got],
        }

    return arrow_pass(pick(docs, doc_id="long", text="string"), work,
                      "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long", keep=("doc_id",))
