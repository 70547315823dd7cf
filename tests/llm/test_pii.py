import hashlib
import random
import re
from collections import Counter

from conftest_llm import EDGES
from segwatch.llm import pii
from segwatch.llm.pii import find, find_plain, joined, personal_data, redact

# The four kinds as plain patterns, matched from left to right without overlap.
KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(ds):
    return sum(d if i % 2 == 0 else (2 * d) // 10 + (2 * d) % 10 for i, d in enumerate(reversed(ds))) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def test_random_texts():
    rng = random.Random(8)
    pool = [*"0123456789" * 2, *"..@@++--  ()", *"ab%_", "4111 1111 1111 1111", "+1 (555) 123-4567", "a.b@c.de", "10.0.0.255", "é", "\n", "256"]
    for _ in range(20_000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(1, 40)))
        assert sorted(find_plain(text)) == sorted(plain(text)), text
        base, added = find(text)
        assert base == find_plain(text) and added == []


def test_documents(documents):
    df, rows = documents
    got = Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in personal_data(df).collect())
    wanted = Counter()
    for i, t in rows:
        spans = plain(t or "")
        wanted[i, *(sum(s[0] == k for s in spans) for k in KINDS), hashlib.sha256(joined(spans).encode()).hexdigest()] += 1
    assert got == wanted


def test_disguises_map_back_to_the_source():
    cases = {
        "write to john (dot) doe (at) example (dot) com now": [("email", "john (dot) doe (at) example (dot) com")],
        "bob at mail dot example dot org": [("email", "bob at mail dot example dot org")],
        "ann[at]example[dot]net": [("email", "ann[at]example[dot]net")],
        "eva&#64;example.org": [("email", "eva&#64;example.org")],
        "call plus one five five five one two three four five six seven!": [("phone", "plus one five five five one two three four five six seven")],
        "four one one one, one one one one, one one one one, one one one one": [("card", "four one one one, one one one one, one one one one, one one one one")],
        "jоhn@exаmple.com": [("email", "jоhn@exаmple.com")],
        "jo​hn@exam​ple.com": [("email", "jo​hn@exam​ple.com")],
        "１９２.168.1.1": [("ip", "１９２.168.1.1")],
        "mail john@example[.]com": [("email", "john@example[.]com")], "host 10.0.0[.]1 is": [("ip", "10.0.0[.]1")],
        "to john at example (.) com": [("email", "john at example (.) com")], "to john ( @ ) example.com": [("email", "john ( @ ) example.com")],
        "to john <@> example.com": [("email", "john <@> example.com")], "to john < at > example.com": [("email", "john < at > example.com")],
        "🎉 é a dot b, look at example.com": [],
        "we met at noon and one two of them": [],
    }
    for text, wanted in cases.items():
        _, added = find(text)
        assert [(k, text[s:e]) for k, s, e in added] == wanted, text


def test_the_quick_look_never_hides_a_disguise():
    """Wherever the pattern matches, the shorter one that is looked for first does, too."""
    draw = random.Random(12)
    pool = ["a", "bob", "x-y", " at ", " AT ", " dot ", " Dot\n", "(", ")", "[", "]", "<", ">", "{", "@", ".", " ", "  ", "at", "dot", "punkt", "arroba", "&#64;", "&period;", "org"]
    hits = 0
    for _ in range(60_000):
        text = "".join(draw.choice(pool) for _ in range(draw.randint(2, 12)))
        if pii.AT_DOT.search(text):
            hits += 1
            assert pii.AT_DOT_CORE.search(text.lower()), text
    assert hits > 5000


def test_plain_spans_stay_beside_disguised_ones():
    text = "a@b.co and x (at) y (dot) org, 10.0.0.1"
    plain_spans, added = find(text)
    assert [text[s:e] for _, s, e in plain_spans] == ["a@b.co", "10.0.0.1"] and [text[s:e] for _, s, e in added] == ["x (at) y (dot) org"]
    assert redact(text, plain_spans + added) == "<EMAIL> and <EMAIL>, <IP>"


def test_edges(edges):
    done = personal_data(edges, redacted=True)
    assert Counter((r["doc_id"], r["text"]) for r in done.collect()) == Counter(EDGES)
    assert {(r["spans"], r["n_added"], r["base_sha256"]) for r in done.collect()} == {("", 0, hashlib.sha256(b"").hexdigest())}
    assert personal_data(edges.limit(0)).collect() == []


def test_long_texts_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "@a" * 100_000, "+1" * 100_000, "one " * 50_000, "<" * 100_000,
                 " " * 100_000, "a " * 50_000 + " " * 100_000 + "(", "( " * 100_000):
        find(text)


def test_many_disguised_addresses_take_linear_time():
    text = "ann (at) example (dot) org and b@c.de, " * 20_000
    plain_spans, added = find(text)
    assert len(plain_spans) == len(added) == 20_000
    assert {text[s:e] for _, s, e in added} == {"ann (at) example (dot) org"}
