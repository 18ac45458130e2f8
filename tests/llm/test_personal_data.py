import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from marketlane.llm import personal_data
from tests.llm.frames import ODD, documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_base(text):
    """The stated expressions as they stand."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and plain_luhn(digits(m))]
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return out


PIECES = ["a@b.c", "@", ".", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111111111111111", "+1 (555) 010-9999", "+", " ", "-", "é", "x_y%z", "9", "\n"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text("ab1.@+- ()0", max_size=6)), max_size=14))
def test_base_equals_the_stated_expressions(pieces):
    text = "".join(pieces)
    assert personal_data.base_spans(text) == plain_base(text)
    found = personal_data.mentions(text, personal_data.base_spans(text))
    taken = [(m["start"], m["stop"]) for m in found if m["kind"] is not None]
    for m in found:
        assert m["value"] == text[m["start"] : m["stop"]].lower()
        if m["kind"] is None:
            assert not any(a < m["stop"] and m["start"] < b for a, b in taken)


def corpus(seed=0, count=600):
    """Identifiers in telling surroundings, in forms that the expressions miss, and noise of the same look elsewhere."""
    rng = random.Random(seed)
    words = [f"w{k}x".replace("0", "o").replace("1", "l") for k in range(2, 9)] + ["the", "of", "and", "in", "la"]
    words = [re.sub("[0-9]", "q", w) for w in words]
    out = []
    for k in range(count):
        noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
        hidden, text = None, noise(rng.randint(3, 12))
        pick = rng.random()
        if pick < 0.25:
            text += f" please phone: +1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)} today"
        elif pick < 0.32:
            hidden = f"(0{rng.randint(10, 99)}) 555-{rng.randint(1000, 9999)}"
            text += f" please phone: {hidden} today"
        elif pick < 0.5:
            text += f" write to u{k}@mail.example.com soon"
        elif pick < 0.55:
            hidden = f"u{k}(at)mail.example.com"
            text += f" write to {hidden} soon"
        elif pick < 0.7:
            text += f" order {rng.randint(10**7, 10**8)} {noise(1)}"
        elif pick < 0.8:
            text += f" {noise(1)} 10.{rng.randint(0, 255)}.3.{rng.randint(0, 255)}"
        out.append((k, text + " " + noise(rng.randint(2, 8)) + ".", hidden))
    return out


def plain_discoveries(texts, prior=personal_data.PRIOR, least=personal_data.LEAST):
    """The same scores with dictionaries over whole lists."""
    places = [m for t in texts for m in personal_data.mentions(t, plain_base(t))]
    known = {}
    for m in places:
        if m["kind"] is not None:
            known[m["value"]] = min(m["kind"], known.get(m["value"], 9))
    graph = defaultdict(set)
    for m in places:
        for name in ("before", "around"):
            if m[name] is not None:
                graph[name, m[name]].add(m["value"])
    looks = {
        0: lambda v: re.search(r"^[^@]+@[^@]+$|[(\[]at[)\]]", v),
        1: lambda v: re.fullmatch(r"[0-9a-f.:]+", v) and sum(c in ".:" for c in v) >= 3,
        2: lambda v: re.fullmatch("[0-9 -]+", v) and 12 <= sum(c.isdigit() for c in v) <= 19,
        3: lambda v: re.fullmatch("[0-9 ().+/-]+", v) and 7 <= sum(c.isdigit() for c in v) <= 15,
    }
    found = {}
    while True:
        doubt = defaultdict(lambda: 1.0)
        for values in graph.values():
            for kind, number in Counter(known[v] for v in values if v in known).items():
                confidence = number / (len(values) + prior)
                if confidence >= personal_data.WEAK:
                    for v in values:
                        if v not in known:
                            doubt[v, kind] *= 1 - confidence
        new = {}
        for (v, kind), d in sorted(doubt.items(), key=lambda x: (x[1], x[0][1])):
            if 1 - d >= least - 1e-9 and looks[kind](v):
                new.setdefault(v, kind)
        if not new:
            return found
        found |= new
        known |= new


def test_patterns_find_what_the_expressions_miss(spark):
    rows = corpus()
    df = personal_data.personal_data(documents(spark, [(k, t) for k, t, _ in rows])).collect()
    got = {r["doc_id"]: r for r in df}
    expected = plain_discoveries([t for _, t, _ in rows])
    assert len(expected) > 20
    for k, text, hidden in rows:
        base = plain_base(text)
        added = [(expected[m["value"]], m["start"], m["stop"]) for m in personal_data.mentions(text, base) if m["kind"] is None and m["value"] in expected]
        line = lambda spans: ",".join(f"{personal_data.KINDS[a]}:{b}:{c}" for a, b, c in sorted(spans))
        assert got[k]["spans"] == line(base + added) and got[k]["n_found"] == len(added)
        assert got[k]["base_sha256"] == hashlib.sha256(line(base).encode()).hexdigest()
        assert [got[k][f"n_{n}"] for n in personal_data.KINDS] == [sum(s[0] == i for s in base) for i in range(4)]
    hidden = [(k, t, h) for k, t, h in rows if h]
    caught = sum(1 for k, t, h in hidden if got[k]["n_found"])
    assert caught >= 0.9 * len(hidden)
    # numbers of the same look in other surroundings stay
    assert not any(got[k]["n_found"] for k, t, h in rows if not h)


def test_rounds_go_on_until_nothing_is_added(spark):
    """Values found in one surrounding make the next one a pattern."""
    rows = [f"please phone: +1 (555) 555-{1000 + k} today" for k in range(20)]
    rows += [f"please phone: (020) 555-{2000 + k} today" for k in range(40)]
    rows += [f"ring us on (020) 555-{2000 + k} now" for k in range(40)]
    rows += [f"ring us on (030) 555-{3000 + k} now" for k in range(2)]
    texts = [" ".join(t.split()) for t in rows]
    # the second surrounding is learnt from values that only the first one found
    seeds = [f"please phone: +1 (555) 777-{1000 + k} today" for k in range(200)]
    df = personal_data.personal_data(documents(spark, list(enumerate(seeds + texts)))).collect()
    found = {r["doc_id"] for r in df if r["n_found"]}
    assert found == set(range(220, 220 + 82))
    assert len(plain_discoveries(seeds + texts)) == 42


def test_odd_rows(spark):
    rows = [*ODD, (10, "call +1 (555) 010-9999"), (10, "call +1 (555) 010-9999"), (None, "a@b.co"), (11, "9" * 50_000), (12, "a." * 30_000 + "@"), (13, "+1" + " " * 50_000)]
    df = personal_data.personal_data(documents(spark, rows))
    got = df.collect()
    assert len(got) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    for r in got:
        if r["doc_id"] in (1, 2, 3, 5, 11, 12, 13):
            assert r["spans"] == "" and r["base_sha256"] == empty
    assert [r["spans"] for r in got if r["doc_id"] == 10] == ["phone:5:22"] * 2
    assert [r["spans"] for r in got if r["doc_id"] is None and r["n_email"]] == ["email:0:6"]
    none = personal_data.personal_data(documents(spark, []))
    assert none.count() == 0 and none.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_found"]


@pytest.mark.parametrize("digits", ["4111111111111111", "79927398713", "49927398716", "1234567890123"])
def test_luhn(digits):
    assert personal_data.luhn(digits) == plain_luhn(digits)
