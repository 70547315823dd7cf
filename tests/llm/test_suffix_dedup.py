import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from conftest_llm import EDGES
from segwatch.llm import suffix_dedup as suffix


def plain(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    often = Counter(b[n:n + length] for _, b in raw for n in range(len(b) - length + 1))
    out = Counter()
    for i, b in raw:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for n in range(len(b) - length + 1):
            if often[b[n:n + length]] > 1:
                gone[n:n + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        left = bytes(np.frombuffer(b, dtype="uint8")[~gone[:-1]])
        out[i, len(b), int(gone[:-1].sum()), runs, hashlib.sha256(left).hexdigest()] += 1
    return out


def plain_words(rows, length, keep_first):
    """Key, covered words and the text that is left, by every string of words; rows with key and text alike are one."""
    word = re.compile("[^\\x20\\x09-\\x0d]+")
    docs = [(i, t, list(word.finditer(t or ""))) for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, mark(r[1])))]
    places = {}
    for k, (_, _, ws) in enumerate(docs):
        for n in range(len(ws) - length + 1):
            places.setdefault(tuple(w.group() for w in ws[n:n + length]), []).append((k, n))
    often = Counter((i, t) for i, t in rows)
    done = {}
    for k, (i, t, ws) in enumerate(docs):
        gone = [False] * len(ws)
        for n in range(len(ws) - length + 1):
            where = places[tuple(w.group() for w in ws[n:n + length])]
            if where[0] != (k, n) if keep_first else len(where) > 1 or often[i, t] > 1:
                gone[n:n + length] = [True] * length
        runs = re.finditer("x+", "".join("x" if g else "." for g in gone))
        left, at = "", 0
        for m in runs:
            left += (t or "")[at:ws[m.start()].start()]
            at = ws[m.end() - 1].end()
        done[i, t] = (i, sum(gone), None if t is None else left + t[at:])
    return Counter(done[r] for r in rows)


def mark(text):
    """The order of documents that have no key or the same: by the hash of their text."""
    seen = xxhash.xxh64(text.encode(), seed=42).intdigest() if text is not None else 42
    return seen - 2**64 if seen >= 2**63 else seen


def words_of(df, **more):
    rows = suffix.suffix_dedup(df, words=True, kept=True, **more).collect()
    return Counter((r["doc_id"], r["covered"][0], r["kept"]) for r in rows)


def test_words_of_documents(documents):
    df, rows = documents
    assert words_of(df, length=51, keep_first=True) == plain_words(rows, 51, True)


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("sorted_contexts", [4096, 2])
def test_short_strings_of_words(spark, monkeypatch, keep_first, sorted_contexts):
    monkeypatch.setattr(suffix, "SORTED_CONTEXTS", sorted_contexts)
    rows = [(i // 2, t.replace("c", " ").replace("f", "\n ")) for i, t in _texts(random.Random(11), 80)]
    rows += rows[:9] + [(200, "word " * 60), (None, "word " * 60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert words_of(df, length=7, keep_first=keep_first) == plain_words(rows, 7, keep_first)


def test_two_kinds_in_one_pass(spark):
    """Strings of words are counted beside strings of bytes, and nothing of them is taken out."""
    shared = " ".join(f"w{i}" for i in range(51))
    rows = [(1, "one " + shared + " end"), (2, "two\n" + shared.replace(" ", "\n")), (3, " ".join(shared.split()[:50]) + " short"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    done = suffix.suffix_dedup(df, counted=[suffix.Strings(51, words=True)])
    assert Counter((r["doc_id"], r["n_removed"], tuple(r["covered"])) for r in done.collect()) == Counter(
        {(1, 0, (0, 51)): 1, (2, 0, (0, 51)): 1, (3, 0, (0, 0)): 1, (4, 0, (0, 0)): 1})


def test_words_are_told_by_their_bytes():
    hasher = suffix.Hasher(4096)
    raw = b"  one two\tone\r\n" + b"x" * 10_000 + b" " + b"x" * 10_001 + b" \xc2\xa0 one"
    starts, ends, hashes = hasher.words(np.frombuffer(raw, dtype="uint8"))
    found = [raw[i:j] for i, j in zip(starts, ends)]
    assert found == raw.split() and len(set(hashes.tolist())) == len(set(found))
    assert dict(zip(found, hashes)) == dict(zip(found, suffix.Hasher(1 << 16).words(np.frombuffer(raw, dtype="uint8"))[2])) | {
        w: h for w, h in zip(found, hashes) if len(w) > 4096}


def test_one_hash_for_two_words_is_found(monkeypatch):
    """With one hash for all words every string looks repeated; the bytes say that it is not."""
    hasher = suffix.Hasher(4096)
    monkeypatch.setattr(suffix, "_mixed", lambda x: x * np.uint64(0) + np.uint64(7))
    contexts = [b" ".join(b"a%d" % i for i in range(16)), b" ".join(b"b%d" % i for i in range(16))]
    with pytest.raises(ArithmeticError, match="64-bit"):
        suffix.covered_ranges(contexts, np.array([4, 4]), np.array([0, 0]), 12, hasher)


def result(df, **more):
    rows = suffix.suffix_dedup(df, **more).collect()
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in rows)


def test_documents(documents):
    df, rows = documents
    assert result(df) == plain(rows, 400)


def _texts(rng, n):
    base = "".join(rng.choice("abcdefgh ") for _ in range(400))
    out = []
    for i in range(n):
        t = list(base[rng.randint(0, 200):]) if rng.random() < 0.7 else [rng.choice("abé🎉") for _ in range(rng.randint(0, 200))]
        for _ in range(rng.randint(0, 4)):
            if t:
                t[rng.randrange(len(t))] = rng.choice("xyzé")
        out.append((i, "".join(t[:25] * 8 if rng.random() < 0.2 else t)))
    return out


@pytest.mark.parametrize("length", [8, 41, 60])
@pytest.mark.parametrize("sorted_contexts", [4096, 2])
def test_short_strings(spark, monkeypatch, length, sorted_contexts):
    monkeypatch.setattr(suffix, "SORTED_CONTEXTS", sorted_contexts)  # with 2 nearly all anchors are counted in the whole table
    rows = _texts(random.Random(length), 60)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert result(df, length=length) == plain(rows, length)


def test_segments_of_long_texts(monkeypatch):
    rng = random.Random(2)
    data = np.frombuffer("".join(rng.choice("abcd") for _ in range(5000)).encode(), dtype="uint8")
    whole = suffix.anchors(data, suffix.Hasher(10_000), 60)
    monkeypatch.setattr(suffix, "SEGMENT_BYTES", 130)
    parts = suffix.anchors(data, suffix.Hasher(10_000), 60)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


@pytest.mark.parametrize("length", [60, 400])
def test_edges(edges, length):
    done = suffix.suffix_dedup(edges, length=length, kept=True, carry=["spans", "size"])
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in done.collect()) == plain(EDGES, length)
    assert {r["kept"] for r in done.where("doc_id = 2").collect()} == {None} and done.head()["carried"].asDict() == {"spans": "x", "size": 1}
    assert suffix.suffix_dedup(edges.limit(0)).collect() == []


@pytest.mark.parametrize("words", [False, True])
def test_joined_texts_have_the_anchors_of_each(words):
    rng = random.Random(6)
    raws = ["".join(rng.choice("ab c\n") for _ in range(rng.choice([0, 5, 30, 200]))).encode() for _ in range(60)]
    hasher = suffix.Hasher(1 << 16)
    text, chosen, place, found, left, right, symbols = suffix._joined_anchors(raws, hasher, 12, words)
    got = [(int(t), int(p), int(h)) for t, p, h in zip(text, place, found)]
    wanted = []
    for n, raw in enumerate(raws):
        own = np.frombuffer(raw, dtype="uint8")
        where, hashes = suffix.anchors(hasher.words(own)[2] if words else own, hasher, 12)
        wanted += [(n, int(p), int(h)) for p, h in zip(where, hashes)]
    assert got == wanted and len(got) > 50


def test_collision_is_found_and_answered(monkeypatch):
    """With all sign values zero every comparison collides; another multiplier cannot help, other values do."""
    real, calls = suffix._byte_values, []

    def values():
        calls.append(1)
        return np.zeros(256, dtype="uint64") if len(calls) == 1 else real()

    monkeypatch.setattr(suffix, "_byte_values", values)
    contexts = [b"a" * 30 + b"b" * 30, b"a" * 30 + b"c" * 30]
    low, high = suffix.covered_ranges(contexts, np.array([20, 20]), np.array([0, 0]), 40)
    assert len(calls) == 2 and not high.any()


def test_sort_is_a_suffix_sort():
    rng = random.Random(4)
    contexts = list({"".join(rng.choice("ab") for _ in range(60)).encode() for _ in range(200)})
    shard = suffix.SuffixShard(contexts, np.full(len(contexts), 20), np.zeros(len(contexts), dtype="int64"), 40)
    place = shard.first + 5
    order, _, common = shard.sort(np.arange(len(contexts)), place)
    wanted = sorted(range(len(contexts)), key=lambda c: contexts[c][5:])
    assert [contexts[c][5:] for c in order] == [contexts[c][5:] for c in wanted]
    for a, b, n in zip(order, order[1:], common[1:]):
        x, y = contexts[a][5:], contexts[b][5:]
        assert n == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), len(x))


def _plain_ranges(contexts, left, groups, length, wanted):
    """By every string of every context: what strings that another context of the group has at the same place cover."""
    shift = length - length // 2
    have = {}
    for c, (body, l, g) in enumerate(zip(contexts, left, groups)):  # noqa: E741
        for t in range(shift - l, shift - l + len(body) - length + 1):
            have.setdefault((g, t, body[t - shift + l:][:length]), []).append(c)
    out = [(0, 0)] * len(contexts)
    for (_, t, _), some in have.items():
        for c in some if len(some) > 1 else ():
            low, high = out[c] if out[c] != (0, 0) else (t - shift, t - shift + length)
            out[c] = (min(low, t - shift), max(high, t - shift + length))
    return [r if w else (0, 0) for r, w in zip(out, wanted)]


def _framed(rng, n, length, groups):
    """Contexts of some anchors that have much in common with one another to either side, often with different ones."""
    shift, block = length - length // 2, length // 2
    sides = [["".join(rng.choice("ab") for _ in range(shift)) for _ in range(6)] for _ in range(2)]
    rows = set()
    while len(rows) < n:
        cut = [rng.choice([0, 0, rng.randint(0, shift)]) for _ in range(2)]
        mixed = ["".join(a if i < rng_cut else b for i, (a, b) in enumerate(zip(*rng.sample(s, 2))))
                 for s, rng_cut in ((sides[0], rng.randint(0, shift)), (sides[1], rng.randint(0, shift)))]
        before, after = mixed[0][cut[0]:], mixed[1][:shift - cut[1]]
        if len(before) + len(after) + block >= length:
            rows.add((rng.randrange(groups), len(before), (before + "c" * block + after).encode()))
    rows = sorted(rows, key=lambda r: (r[0], rng.random()))
    return [r[2] for r in rows], np.array([r[1] for r in rows]), np.array([r[0] for r in rows])


@pytest.mark.parametrize("length", [6, 12, 40])
def test_ranges_are_those_of_every_string(length):
    rng = random.Random(length)
    for _ in range(120):
        contexts, left, groups = _framed(rng, 60 if length > 6 else 25, length, rng.choice([1, 3, 12]))
        wanted = np.array([rng.random() < 0.8 for _ in contexts])
        truth = _plain_ranges(contexts, left, groups, length, wanted)
        low, high = suffix.covered_ranges(contexts, left, groups, length, wanted=wanted)
        assert list(zip(low.tolist(), high.tolist())) == truth
    spaced = [b" ".join(bytes([b]) for b in c) for c in contexts]
    low, high = suffix.covered_ranges(spaced, left, groups, length, suffix.Hasher(1 << 14), wanted=wanted)
    assert list(zip(low.tolist(), high.tolist())) == truth


def test_few_suffixes_are_compared(monkeypatch):
    """A context of an anchor that one other text shares takes a few comparisons, not some for each place of a grid."""
    rng = random.Random(9)
    contexts, left, groups = [], [], []
    for g in range(50):
        one = bytes(rng.choice(b"abcdefgh") for _ in range(600))
        contexts += [one, one[:520] + bytes(rng.choice(b"ijkl") for _ in range(80))]
        left += [200, 200]
        groups += [g, g]
    compared, real = [], suffix.SuffixShard.extension
    monkeypatch.setattr(suffix.SuffixShard, "extension", lambda self, a, *more, **named: compared.append(len(a)) or real(self, a, *more, **named))
    low, high = suffix.covered_ranges(contexts, np.array(left), np.array(groups), 400)
    assert (low == -200).all() and (high == 320).all()
    assert sum(compared) <= 8 * len(contexts)
