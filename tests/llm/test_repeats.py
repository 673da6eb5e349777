"""Repeated byte strings and phrases against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from wearline.llm import fmindex, phrases, suffixes, windows

PARTS = ["the", "of", "ation", "élan", "xx", "re", "on", "\n", "ha", "\x01a"]


def corpus(seed: int, rows: int = 120):
    draw = random.Random(seed)
    text = lambda n: " ".join(draw.choice(PARTS) for _ in range(n))
    bases = [text(draw.randint(0, 200)) for _ in range(20)]
    out = []
    for i in range(rows):
        kind, base = draw.random(), draw.choice(bases)
        if kind < 0.2:
            t = base
        elif kind < 0.6:
            at = draw.randint(0, len(base))
            t = base[:at] + draw.choice("abc é") + base[at + draw.randint(0, 2) :]
        elif kind < 0.8:
            other = draw.choice(bases)
            t = base[draw.randint(0, len(base)) :] + text(3) + other[: draw.randint(0, len(other))]
        else:
            t = draw.choice(["", "a" * draw.randint(0, 200), None, "ab" * 60, "x y " * 40, text(100)])
        out.append((i * 3, t))
    out += [(6, out[2][1]), (6, out[2][1]), (None, bases[0]), (None, bases[1])]
    return out


def least(key):
    return windows.NO_KEY if key is None else key


def covered(rows, split, window):
    """Per row the symbols and which of them go."""
    seen = {}
    for key, text in sorted(rows, key=lambda r: least(r[0])):
        s = split((text or "").encode())
        for i in range(len(s) - window + 1):
            seen.setdefault(tuple(s[i : i + window]), least(key))
    out = []
    for key, text in rows:
        s = split((text or "").encode())
        gone = np.zeros(len(s), bool)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i : i + window])] < least(key):
                gone[i : i + window] = True
        out.append((key, s, gone))
    return out


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_against_brute_force(docs_of, seed):
    rows = corpus(seed)
    want = []
    for key, s, gone in covered(rows, list, 50):
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((key, len(s), spans, bytes(b for b, g in zip(s, gone) if not g)))
    got = [(r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in suffixes.remove_repeated_bytes(docs_of(rows)).collect()]
    assert order(got) == order(want)


@pytest.mark.parametrize("seed", [3, 4])
def test_phrases_against_brute_force(docs_of, seed):
    rows = corpus(seed)
    want = []
    for key, s, gone in covered(rows, bytes.split, 13):
        kept = b" ".join(w for w, g in zip(s, gone) if not g).decode()
        want.append((key, len(s), int(gone.sum()), kept))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in phrases.remove_repeated_phrases(docs_of(rows)).collect()]
    assert order(got) == order(want)


def surrounded(seed: int):
    """Stock phrases in most rows, all with other words around them, some of these repeated."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6)))
    short, long = "all rights are reserved by the owner", " ".join(word() for _ in range(30))
    around = [" ".join(word() for _ in range(12)) for _ in range(40)]
    pick = lambda: draw.choice([draw.choice(around), " ".join(word() for _ in range(12))])
    rows = [(i, f"{pick()} {draw.choice([short, short, long])} {pick()}") for i in range(150)]
    # Many rows without a key, copies among them, and one text under one key again and again.
    rows += [(None, f"{pick()} {short} {pick()}") for _ in range(60)] + [(None, rows[0][1])] * 30 + [(40, rows[1][1])] * 30
    return rows


@pytest.mark.parametrize("many", [4, 40])
def test_frequent_grams_and_keys_are_spread(docs_of, many):
    rows = surrounded(many)
    want, words = [], []
    for key, s, gone in covered(rows, list, 50):
        want.append((key, len(s), bytes(b for b, g in zip(s, gone) if not g)))
    for key, s, gone in covered(rows, bytes.split, 13):
        words.append((key, len(s), b" ".join(w for w, g in zip(s, gone) if not g).decode()))
    docs = docs_of(rows).withColumnsRenamed({"id": "k", "score": "same", "salt": "times"}).repartition(4)
    got = windows.remove_repeats(docs, suffixes.FINDER, many=many).collect()
    assert order((r.doc_id, r.n_bytes, bytes(r.kept)) for r in got) == order(want)
    got = windows.remove_repeats(docs, phrases.FINDER, many=many).collect()
    assert order((r.doc_id, r.n_words, r.kept) for r in got) == order(words)


def test_windows_of_a_frequent_gram_are_dealt_out_one_by_one(monkeypatch):
    text = (b"x" * 60 + b"0123456789abcdefghijklmnopqrstuvwxyz" * 4 + b"y" * 60) * 5
    codes, starts, _ = suffixes.symbols(pa.array([text]))
    a = windows.anchors(codes, starts, 50, 16)
    idents = windows._ident(a.hash, 7).astype(np.int64)
    hot = int(max(idents, key=lambda g: len({text[w : w + 50] for i in np.flatnonzero(idents == g) for w in range(a.first[i], a.last[i] + 1)})))
    monkeypatch.setattr(windows, "_frequent", lambda _: (np.array([hot]), np.array([3])))
    b = windows._parted(a, codes, suffixes.FINDER, 7, "")
    mine = idents == hot
    of_window = lambda x: {w: (int(p), int(h)) for p, f, l, h in zip(x.at, x.first, x.last, x.hash) for w in range(f, l + 1)}
    before, after = of_window(a), of_window(b)
    assert before.keys() == after.keys() and all(before[w][0] == after[w][0] for w in before)
    changed = {w for w in before if before[w][1] != after[w][1]}
    assert changed == {w for f, l, m in zip(a.first, a.last, mine) if m for w in range(f, l + 1)}
    # Equal windows stay together.
    by_text = {}
    for w in changed:
        assert by_text.setdefault(text[w : w + 50], after[w][1]) == after[w][1]
    assert len({after[w][1] for w in changed}) > 1


def test_an_index_takes_whole_grams(monkeypatch):
    monkeypatch.setattr(windows, "ROOM", 4)
    values = np.array([1, 1, 2, 3, 3, 3, 3, 3, 3, 4, 5])
    parts = [values[s].tolist() for s in windows._groups(values)]
    assert parts == [[1, 1, 2], [3] * 6, [4, 5]] and list(windows._groups(values[:0])) == []


def test_spans_are_the_removed_bytes(docs_of):
    shared = "abcdefghij" * 8
    rows = [(1, shared), (2, "é" + shared + "-" + shared), (3, "x" * 49)]
    got = {r.doc_id: r for r in suffixes.remove_repeated_bytes(docs_of(rows)).collect()}
    assert [(s.start, s.end) for s in got[2].spans] == [(2, 82), (83, 163)]
    assert bytes(got[2].kept) == "é-".encode() and got[1].spans == []


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, ""), (1, ""), (2, "")]])
def test_empty_tables_and_texts(docs_of, rows):
    assert suffixes.remove_repeated_bytes(docs_of(rows)).count() == len(rows)
    assert phrases.remove_repeated_phrases(docs_of(rows)).count() == len(rows)


def test_a_hot_passage_and_a_long_text(docs_of):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"start{i} {passage} end{i}") for i in range(300)]
    rows.append((1000, " ".join(f"u{i}" for i in range(60_000)) + " " + passage))
    got = {r.doc_id: r for r in phrases.remove_repeated_phrases(docs_of(rows)).collect()}
    assert got[0].n_removed == 0
    assert all(got[i].n_removed == 60 for i in [*range(1, 300), 1000])


def test_suffix_order_by_cover_ranks():
    draw = np.random.default_rng(1)
    text = draw.integers(97, 99, 448).astype(np.uint8)
    text = np.concatenate([text, text[:224], np.zeros(suffixes.SLOT + 8, np.uint8)])
    sample, _ = suffixes.cover_order(suffixes._words(text), 6, 112, 40, 50)
    raw = text.tobytes()
    assert sorted(sample % 112)[-1] <= 40
    # Whole slots hold 64 bytes from these places on.
    assert [raw[i : i + 64] for i in sample] == sorted(raw[i : i + 64] for i in sample)
    assert {(a - b) % 16 for a in suffixes.COVER for b in suffixes.COVER} == set(range(16))


def test_backward_search_counts_occurrences():
    draw = np.random.default_rng(2)
    text = draw.integers(1, 6, 500)
    index = fmindex.FmIndex(text, 8)
    for size in (1, 3, 8):
        at = draw.integers(0, 500 - size, 50)
        low, high = index.all(len(at))
        for back in reversed(range(size)):
            low, high = index.step(text[at + back], low, high)
        want = [sum((text[i : i + size] == text[a : a + size]).all() for i in range(500 - size + 1)) for a in at]
        assert (high - low).tolist() == want
        places = index.order[low[0] : high[0]]
        assert all((text[p : p + size] == text[at[0] : at[0] + size]).all() for p in places)


@pytest.mark.parametrize("places", [64, 100, 1 << 10])
def test_anchors_of_slices_are_those_of_the_whole(monkeypatch, places):
    draw = np.random.default_rng(places)
    sizes = np.array([0, 700, 49, 50, 0, 3, 900, 1500, 51])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    symbols = draw.integers(0, 1 << 63, int(starts[-1]), dtype=np.uint64)
    symbols[800:1300] = 7
    whole = windows.anchors(symbols, starts, 50, 16)
    monkeypatch.setattr(windows, "PLACES", places)
    cut = windows.anchors(symbols, starts, 50, 16)
    for name in ("at", "row", "hash", "first", "last"):
        assert (getattr(cut, name) == getattr(whole, name)).all()


def test_a_piece_of_more_symbols_than_a_place_holds():
    n = (1 << 24) + 100
    symbols = np.random.default_rng(1).integers(0, 1 << 63, n, dtype=np.uint64)
    found = windows.anchors(symbols, np.array([0, n]), 50, 16)
    assert found.first[0] == 0 and found.last[-1] == n - 50 and (found.first[1:] == found.last[:-1] + 1).all()
