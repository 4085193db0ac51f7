"""Operator 1: chunk borders, planted passages, and edge rows."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import substring_dedup as sd

SCHEMA = "doc_id long, text string, removed_spans int, place string"
RNG = random.Random(4)
VOCAB = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 9))) for _ in range(3000)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def slow_gear(text):
    h, out = [], []
    for c in text:
        v = int(sd.mix64(np.array([ord(c)], np.uint64))[0] >> np.uint64(32)) if c != "\0" else 0
        h = (h + [v])[-sd.WINDOW:]
        x = sum(g << (len(h) - 1 - i) for i, g in enumerate(h)) % 2**32
        x = ((x ^ (x >> 15)) * 0x2C1B3C6D) % 2**32
        out.append(((x ^ (x >> 13)) * 0x297A2D39) % 2**32)
    return out


def test_gear_hash_rolls():
    text = prose(30) + "é\0日"
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    assert sd.gear(codes).tolist() == slow_gear(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=300), max_size=6))
def test_chunks_cover_texts_and_stand_alone(texts):
    together = sd.chunks(texts)
    assert len(together) == len(texts)
    for text, (border, digest) in zip(texts, together):
        assert border[0] == 0 and border[-1] == len(text) and (np.diff(border) > 0).all()
        assert len(digest) == len(border) - 1
        (alone, same), = sd.chunks([text])
        assert alone.tolist() == border.tolist() and same.tolist() == digest.tolist()


def test_borders_survive_insertions():
    text = prose(400)
    (border, digest), = sd.chunks([text])
    at = len(text) // 2
    (_, moved), = sd.chunks([text[:at] + " inserted words " + text[at:]])
    assert len(set(digest.tolist()) - set(moved.tolist())) <= 4
    assert 20 < np.diff(border).mean() < 50


def test_planted_passages_go_and_clean_texts_stay(rows):
    passages = [prose(n) for n in (51, 55, 60, 80, 120)]
    line = prose(10)
    data = [(i, line + "\n" + prose(200)) for i in range(40)]
    planted = {}
    for i in range(100, 160):
        p = passages[i % 5]
        a, b = prose(RNG.randint(0, 80)), prose(RNG.randint(0, 80))
        planted[i] = (a, p, b)
        data.append((i, f"{a} {p} {b}"))
    data += [(7000, None), (7001, ""), (None, prose(60)), (7002, passages[0]), (7003, "y" * 100000)]
    twice = (7004, prose(90))
    data += [twice, twice]
    docs = rows([(k, t, 5, "here") for k, t in data], SCHEMA)
    out = {r.doc_id: r for r in sd.substring_dedup(docs).collect()}
    assert sd.substring_dedup(docs).count() == len(data)
    texts = dict(data)
    for k in list(range(40)) + [7000, 7001, None, 7003, 7004, 100, 101, 102, 103, 104]:
        assert out[k].text == texts[k] and not out[k].removed_spans, k
    for k, (a, p, b) in planted.items():
        if k >= 105:
            old, new = texts[k], out[k].text
            gone = sum(s.end - s.start for s in out[k].removed_spans)
            assert len(old) - len(new) == gone > len(p) / 2, (k, len(p), gone)
            assert p not in new and new.startswith(a[:max(0, len(a) - 200)])
            s, e = out[k].removed_spans[0]
            assert len(a) - 60 <= s and e <= len(a) + len(p) + 62
    assert len(out[7002].text) < len(passages[0]) / 2
    assert all(r.place == "here" for r in out.values())


def test_passages_of_51_short_words_are_found():
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 4))) for _ in range(3000)]
    words = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passages = [words(51) for _ in range(1000)]
    before, after = ([f"{words(40)} {p} {words(40)}" for p in passages] for _ in range(2))
    missed = 0
    for text, first, (border, digest) in zip(after, sd.chunks(before), sd.chunks(after)):
        found, places = sd.units(border, digest)
        again = places[np.isin(found, sd.units(*first)[0])]
        missed += not len(sd.repeated_spans(text, border, again))
    assert missed == 0


def test_chunks_from_here_and_there_are_no_repeat(rows):
    """A text whose every chunk stood before, each in another text, never two or three together."""
    parts = [prose(40) for _ in range(60)]
    pieces = []
    for text, (border, _) in zip(parts, sd.chunks(parts)):
        middle = len(border) // 2
        pieces.append(text[border[middle]:border[middle + 1]])
    mixed = "".join(p if p[-1:].isspace() else p + " " for p in pieces)
    docs = rows([(i, p, 0, "") for i, p in enumerate(parts)] + [(1000, mixed, 0, "")], SCHEMA)
    out = {r.doc_id: r for r in sd.substring_dedup(docs).collect()}
    assert out[1000].text == mixed and not out[1000].removed_spans


def test_every_span_stood_elsewhere_as_it_is(rows):
    """Replay on documents: what goes is found, white space aside, piece by piece in one earlier text."""
    docs = rows([(i, t, 0, "") for i, t in replay_texts()], SCHEMA)
    texts = dict(replay_texts())
    flat = {i: " ".join(t.split()) for i, t in texts.items()}
    spans = stitched = 0
    for r in sd.substring_dedup(docs).collect():
        for s in r.removed_spans:
            words = texts[r.doc_id][s.start:s.end].split()
            spans += 1
            stitched += not any(" ".join(words[1:-1]) in f for i, f in flat.items() if i != r.doc_id) and not (
                flat[r.doc_id].count(" ".join(words[1:-1])) > 1)
    assert spans > 50 and stitched == 0


def replay_texts():
    """Texts over few words, so that chunks repeat by chance, and passages copied among them."""
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdef") for _ in range(rng.randint(1, 3))) for _ in range(60)]
    words = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passages = [words(70) for _ in range(10)]
    return [(i, f"{words(300)} {rng.choice(passages) if i % 3 == 0 else ''} {words(100)}") for i in range(250)]


def slow_units(digests, border):
    """Units as plain tuples with their places."""
    n = len(digests)
    size = min(sd.JOINED, n)
    out = [(tuple(digests[i:i + size]), i) for i in range(n - size + 1)] if n else []
    return out + [((d, "alone"), n + i) for i, d in enumerate(digests) if n > 1 and border[i + 1] - border[i] >= sd.LONG_CHUNK]


def test_units_equal_plain_tuples():
    texts = [prose(n) for n in (1, 3, 10, 200)] + ["z" * 5000 + " " + prose(40), "z" * 5000, ""]
    seen, plain = {}, {}
    for border, digest in sd.chunks(texts):
        found, places = sd.units(border, digest)
        slow = slow_units(digest.tolist(), border.tolist())
        assert places.tolist() == [p for _, p in slow]
        for u, (t, _) in zip(found.tolist(), slow):
            assert seen.setdefault(u, t) == t and plain.setdefault(t, u) == u


def test_whole_copies_become_empty(rows):
    text = prose(120)
    out = {r.doc_id: r.text for r in sd.substring_dedup(
        rows([(i, text, 0, "") for i in range(30)], SCHEMA)).collect()}
    assert out[0] == text and all(out[i] == "" for i in range(1, 30))


def test_repeats_inside_one_text(rows):
    p = prose(70)
    text = f"{prose(30)} {p} {prose(30)} {p} {prose(20)}"
    row, = sd.substring_dedup(rows([(1, text, 0, "")], SCHEMA)).collect()
    assert len(row.removed_spans) == 1 and row.text.count(p) == 1


def test_empty(rows):
    assert sd.substring_dedup(rows([], SCHEMA)).collect() == []
