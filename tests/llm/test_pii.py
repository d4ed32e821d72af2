import hashlib
import re
from collections import Counter

import numpy as np
from riverbed.llm import pii
from tests.llm.fixtures import empty, frame, prose, rows

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def brute(text):
    text = text or ""
    only = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(only(m[0])) <= 19 and luhn(only(m[0]))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(only(m[0])) <= 15]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


TEXTS = [
    "a@b.c@d.e x@y z@q. @a.b .@a-.b é@a.b a..b%+-@x-y.z-.q", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3 0001.002.3.255 256.1.1.1 01.2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 4111111111111111", "+49 (30) 1234-567 +1 +12345678 +123456789012345678 +1 2 3 4 5 6 7 8 9x",
    "1" * 4000, "1." * 3000, "+1" * 900, "@" * 500, "a@" * 400, "٤٥٦@a.b ４111111111111111",
]


def test_base_spans_match_the_definition(spark):
    data = rows() + [(2000 + i, t, "en", "s", 1) for i, t in enumerate(TEXTS)]
    got = pii.find(frame(spark, data, extra=True)).collect()
    assert Counter((g.doc_id, g.base_sha256) for g in got) == Counter((r[0], hashlib.sha256(brute(r[1]).encode()).hexdigest()) for r in data)
    for g in got:
        spans = [s for s in g.spans.split(",") if s]
        assert len(spans) == g.n_email + g.n_ip + g.n_card + g.n_phone + g.n_added


def test_repeated_and_similar_tokens_take_the_label_of_a_base_span(spark):
    data = []
    for i in range(40):
        n = f"{20 + i}{3141592 + 7919 * i}"
        data.append((i, f"{prose(i, 20)} call +1 {n[:3]} {n[3:]} now\n{prose(300 + i, 30)} or {n} again {i}", "en", "s", 1))
    data += [(100 + i, f"order 55{i}1234567 of {prose(i, 20)}", "en", "s", 1) for i in range(40)]
    got = {g.doc_id: g for g in pii.find(frame(spark, data)).collect()}
    for i in range(40):
        n = f"{20 + i}{3141592 + 7919 * i}"
        at = data[i][1].index(f" or {n}") + 4
        assert f"phone:{at}:{at + len(n)}" in got[i].spans.split(",")
    assert not any(got[100 + i].n_added for i in range(40))


def test_message_passing_equals_enumeration():
    """On a chain and its skip edges that form a tree, loopy belief propagation is exact."""
    import itertools

    import numpy as np
    model = pii.fit([])
    r = np.random.default_rng(3)
    model = pii.Field(r.normal(size=model.unary.shape), np.zeros_like(model.chain), r.normal(size=model.skip.shape))
    cs = [pii.Candidate(0, 9, 3, "+12345678"), pii.Candidate(500, 508, pii.OTHER, "12345678"), pii.Candidate(1500, 1508, pii.OTHER, "12345678")]
    edges = pii.links(cs)
    assert edges == [(0, 1), (1, 2)]
    x = np.array([pii.shape(c.text) for c in cs], float) @ model.unary
    x = np.maximum(x - x.max(1, keepdims=True), -pii.SURE)
    total = np.zeros((3, pii.OTHER + 1))
    for a, b in itertools.product(range(pii.OTHER + 1), repeat=2):
        p = np.exp(x[1, a] + x[2, b] + model.skip[3, a] + model.skip[a, b])
        total[1, a] += p
        total[2, b] += p
    got = model.labels(cs)
    assert got[0] == 3 and got[1] == total[1].argmax() and got[2] == total[2].argmax()


def test_long_chains_take_the_label_and_those_without_evidence_do_not():
    model = pii.fit([(i, 50 * k, t, b) for i in range(40) for k, (t, b) in enumerate([(f"+1201{3141592 + i}", 3), ("2024", pii.OTHER), (f"55{i}12", pii.OTHER)])])
    numbers = [pii.Candidate(0, 13, 3, "+12013141592")] + [pii.Candidate(500 * i, 500 * i + 10, pii.OTHER, "2013141592") for i in range(1, 31)]
    assert model.labels(numbers) == [3] * 31
    years = [pii.Candidate(500 * i + 200, 500 * i + 204, pii.OTHER, "2024") for i in range(30)]
    assert model.labels(years) == [pii.OTHER] * 30
    both = sorted(numbers + years, key=lambda c: c.start)
    assert model.labels(both) == [pii.OTHER if c.text == "2024" else 3 for c in both]
    # unsure shapes and strong links, as a fitted field has them: the whole chain agrees, no evidence means other
    sure = pii.Field(np.tile([-4.0, -4, -4, -4, 0], (pii.N_FEATURES, 1)) / pii.N_FEATURES, 0 * model.chain, np.diag([8.0, 8, 8, 8, 1]))
    assert sure.labels(numbers) == [3] * 31 and sure.labels(numbers[1:]) == [pii.OTHER] * 30 and sure.labels(years) == [pii.OTHER] * 30


def test_a_label_does_not_depend_on_unlinked_tokens():
    model = pii.fit([])
    model.unary[0, 3] = 9.0  # any shape speaks for a phone
    lone = [pii.Candidate(0, 13, 3, "+12013141592"), pii.Candidate(500, 507, pii.OTHER, "5551234")]
    pair = [pii.Candidate(1000, 1010, pii.OTHER, "2013141592"), pii.Candidate(1500, 1504, pii.OTHER, "2024"), pii.Candidate(2000, 2004, pii.OTHER, "2024")]
    assert model.labels(lone) == [3, pii.OTHER]
    assert model.labels(lone + pair) == [3, pii.OTHER, 3, pii.OTHER, pii.OTHER]


def test_numbers_are_alike_where_one_ends_with_the_other():
    of = lambda *texts: pii.links([pii.Candidate(100 * i, 100 * i + len(t), pii.OTHER, t) for i, t in enumerate(texts)])
    assert of("+1 201 3141592", "2013141592") == [(0, 1)] == of("2013141592", "+1 201 3141592")
    assert of("+1 201 3141592", "993141592") == [] == of("993141592", "+1 201 3141592")
    assert of("+1 201 3141592", "993141592", "201-314-1592", "3141592") == [(0, 2), (0, 3), (1, 3), (2, 3)]


def test_spaced_numbers_are_candidates():
    text = "call +1 201 314 1592 or 201 314 1592, in 2020 not 993141592 x1 22 333"
    got = [c.text for c in pii.candidates(text, pii.base_spans(text))]
    assert got == ["+1 201 314 1592", "201 314 1592", "2020", "993141592", "x1", "22", "333"]
    model = pii.fit([(i, 50 * k, t, b) for i in range(40) for k, (t, b) in enumerate([(f"+1201{3141592 + i}", 3), ("2024", pii.OTHER), (f"55{i}12", pii.OTHER)])])
    base, spans = pii.scan(text, model)
    at = text.index("or 201") + 3
    assert set(spans) - set(base) == {(3, at, at + 12)}


def test_many_candidates_in_a_text():
    text = " ".join(f"+1 201 {1000000 + i} n{i}@x.org {2011000000 + i}" for i in range(4000))
    base, spans = pii.scan(text, pii.fit([]))
    assert len(base) == 8000 and len(spans) >= len(base)


def test_links_grow_with_the_tokens():
    cs = [pii.Candidate(10 * i, 10 * i + 8, pii.OTHER, "12345678") for i in range(5000)]
    assert len(pii.links(cs)) == 4999


def test_empty_table(spark):
    assert pii.find(empty(spark)).count() == 0
