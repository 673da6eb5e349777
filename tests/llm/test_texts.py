"""Secret scans, token ids, pieces, archives, quality, benchmark items."""

from __future__ import annotations

import hashlib
import io
import random
import re
import time
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
from tokenizers import Tokenizer

from wearline.llm import archives, automaton, common, files, latent, preference, repair, secrets, sentencepiece_table

ODD = ["", None, " ", "\n", "a", "é" * 50, "日本 語\t🙂", "x" * 5000, "<|endoftext|>a", "<s> </s>", "▁▁ a▁b", "\r\n", "a　b", "ﬁ  "]


def spans_by_re(text, rules):
    out = []
    for order, rule in enumerate(rules):
        for m in automaton.reference(rule.pattern, rule.flags).finditer(text):
            size = len(m.group(2)) if rule.kind == "assign" else len(m.group(0))
            if size >= rule.least:
                out.append((m.start(), order, m.end(), rule.kind))
    points = lambda n: len(text[:n].decode())
    return [(kind, points(a), points(b)) for a, _, b, kind in sorted(out)]


def test_secrets_against_the_regex_module(docs_of):
    draw = random.Random(3)
    parts = ["password", "PASSWD", "secre", "secret", "token", "oken", "api_key", "apikey", " ", "=", ":", "'", '"', "abc", "0123456789abcdef", "AKIA", "ABCDEFGHIJ", "\n", "é", "==", "-----BEGIN RSA PRIVATE KEY-----", "x", "_"]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))) for i in range(4000)]
    rows += [(5000 + i, t) for i, t in enumerate(ODD)] + [(6000, "f" * 200_000), (6001, "token=secret \"= abcdefghijklmnop")]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.find_secrets(docs_of(rows)).collect()}
    assert got == {k: spans_by_re((t or "").encode(), secrets.RULES) for k, t in rows}
    assert got[6001] == []
    assert secrets.find_secrets(docs_of([])).count() == 0


@pytest.mark.parametrize("pattern,flags", [("a(b|cd)*e", ""), ("x{2,4}y?", "i"), ("[^ab]{3}", ""), ("(ab|a)(bc|c)?", "")])
def test_automaton_finds_where_matches_end(pattern, flags):
    dfa = automaton.compile_rules([(pattern, flags)])
    draw = random.Random(5)
    text = "".join(draw.choice("abcdexyXY ") for _ in range(3000)).encode()
    ends, _ = automaton.scan(dfa, np.frombuffer(text, np.uint8), lanes=7)
    rule = automaton.reference(pattern, flags)
    want = [e - 1 for e in range(1, len(text) + 1) if any(rule.fullmatch(text, s, e) for s in range(max(0, e - 60), e))]
    assert ends.tolist() == want


def test_minimal_automaton():
    assert len(automaton.compile_rules([("(ab|cb)", "")], anchored=True).moves) == 4


def test_scan_takes_time_in_proportion_to_its_spans():
    scanner = secrets.Scanner()
    one = b"token = 'abcdefghijkl%05d'\n"

    def seconds(rows):
        data = np.frombuffer(b"".join(one % i for i in range(rows)), np.uint8)
        offsets = np.arange(rows + 1) * (len(data) // rows)
        start = time.perf_counter()
        assert sum(1 for _ in scanner.spans(data, offsets)) == rows
        return time.perf_counter() - start

    seconds(200)
    few, many = min(seconds(2_000) for _ in range(3)), seconds(20_000)
    assert many < 30 * few


def test_redaction_with_clashing_names_and_null_texts(spark):
    rows = [(1, "token: abcdefghijkl", "a", "b"), (1, None, None, "b"), (None, "", "a", None), (None, "plain", "a", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _scanned string, scanned string")
    got = secrets.redact(df)
    assert got.columns == df.columns
    want = [(1, "[assign]", "a", "b"), *rows[1:]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_redaction(docs_of):
    rows = [(1, "é token = abcdefabcdef0123 end"), (2, None), (3, "nothing")]
    df = docs_of(rows)
    got = secrets.redact(df)
    assert got.columns == df.columns
    assert [r.text for r in got.orderBy("doc_id").collect()] == ["é [assign+hex] end", None, "nothing"]


def test_pieces_as_the_library(docs_of):
    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    draw = random.Random(1)
    parts = [" ", "  ", "the", "é", "▁", "\n", "\t", "<s>", "<0x0A>", "日本", "🙂", "　", "word", "\r", "\x00", "123"]
    rows = list(enumerate(ODD + ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(2000)]))
    for r in sentencepiece_table.encode(docs_of(rows), model, with_ids=True).collect():
        ids = library.encode(rows[r.doc_id][1] or "")
        assert (r.ids, r.n_tokens) == (",".join(map(str, ids)), len(ids))
        assert r.decoded == (library.decode(ids) if ids else "")
        assert r.ids_sha256 == hashlib.sha256(r.ids.encode()).hexdigest()
    assert sentencepiece_table.encode(docs_of([]), model).count() == 0


def test_a_small_table_gives_the_same_ids(monkeypatch):
    model = public_tokenizers.path("piece_bpe_32k.model")
    texts = [f"word{i} other{i % 7} é{i}" for i in range(200)]
    whole = sentencepiece_table.ChunkCodec(model).encode(texts)
    monkeypatch.setattr(sentencepiece_table, "TABLE_LIMIT", 20)
    codec = sentencepiece_table.ChunkCodec(model)
    assert [codec.encode([t])[0] for t in texts] == whole


def shards(spark, docs, **more):
    uri = files.folder(spark, "ids")
    path = public_tokenizers.path("byte_bpe_50k.json")
    made = repair.write_shards(docs, uri, path, public_tokenizers.PATTERN, 2, **more)
    return made, repair.read_shards(made, with_ids=True)


def test_token_files_hold_the_library_ids(spark, docs_of):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    draw = random.Random(2)
    rows = [(i * 7 % 101, " ".join(draw.choice(["the", "of", "ation", "élan", "#", "\n", "x1"]) for _ in range(draw.randint(0, 400)))) for i in range(101)]
    rows += [(200 + i, t) for i, t in enumerate(ODD)]
    made, got = shards(spark, docs_of(rows), shard_tokens=5000)
    assert made.count() > 3
    start = 0
    for (key, text), r in zip(sorted(rows, key=lambda r: r[0]), sorted(got.collect())):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (key, start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert shards(spark, docs_of([]))[1].count() == 0


def test_token_files_with_repeated_and_missing_keys(spark, docs_of):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(None, "one two"), (None, "one two"), (None, None), (3, "x y"), (3, "a"), (3, "x y"), (-(1 << 63), "least"), (4, "z" * 100_000)]
    docs = docs_of(rows).withColumnsRenamed({"id": "k", "score": "h", "salt": "t"})
    got = shards(spark, docs, shard_tokens=3)[1].collect()
    ids = {t: library.encode(t or "", add_special_tokens=False).ids + [2] for _, t in rows}
    assert sorted(((r.doc_id, r.ids) for r in got), key=str) == sorted(((k, ids[t]) for k, t in rows), key=str)
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    keys = [r.doc_id for r in got]
    assert keys == [None] * 3 + [-(1 << 63), 3, 3, 3, 4]
    same = [r.ids for r in got if r.doc_id == 3]
    assert same[0] != same[2] and same[1] in (same[0], same[2])


def token_encoder():
    return repair.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def test_long_runs_of_white_space_have_the_library_ids():
    encode = token_encoder()
    for text in (" " * 1_200_000, "a" + "\n" * 1_200_000 + "b<|endoftext|>", "a " * 20 + " " * 1_200_000 + "é"):
        assert encode(text).tolist() == encode.library.encode(text, add_special_tokens=False).ids


def test_splitters_agree_on_every_character_that_is_not_left_to_the_library():
    """The pattern knows letters, numbers, blanks, others, and some letters after an apostrophe."""
    encode = token_encoder()
    cut = encode.library.pre_tokenizer.pre_tokenize_str
    split = regex.compile(public_tokenizers.PATTERN)
    checked = 0
    for code in range(0x110000):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or repair._OTHER.search(c):
            continue
        text = f"a{c}a 1{c}1.{c}. {c} {c}{c}"
        assert [m.span() for m in split.finditer(text)] == [x[1] for x in cut(text)], hex(code)
        checked += 1
    assert checked > 30_000


def test_ids_of_odd_texts():
    encode = token_encoder()
    draw = random.Random(12)
    some = [*"abzé'sdtlvrem019 \n\t\r.,#", "'ll", "'ve", "\x1c", "\x85", "\u00a0", "\u3000", "日", "한", "ß", "🙂", "ǅ", "½", "Ⅷ", "\u0600", "ޱ", "<|endoftext|>"]
    for _ in range(400):
        text = "".join(draw.choice(some) for _ in range(draw.randint(0, 60)))
        assert encode(text).tolist() == encode.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("pays", [2, 6])
def test_no_pair_is_left_that_pays(pays):
    draw = np.random.default_rng(pays)
    parts = [draw.integers(3, 30, draw.integers(1, 40)) for _ in range(60)]
    ids = np.concatenate([np.append(np.concatenate([parts[i] for i in draw.integers(0, 60, 20)] + [np.full(draw.integers(0, 50), 9)]), 2) for _ in range(80)])
    symbols, rules = repair.compress(ids, 2, 100, pays)
    ends = lambda x: x == 2 if x < 100 else ends(int(rules[x - 100][1]))
    inner = np.array([not ends(x) for x in symbols[:-1].tolist()])
    pairs = np.column_stack([symbols[:-1], symbols[1:]])[inner]
    kinds, counts = np.unique(pairs, axis=0, return_counts=True)
    # A run of one symbol counts more pairs than can be replaced.
    assert (counts[kinds[:, 0] != kinds[:, 1]] < pays).all()
    out, known = [], {}
    expand = lambda x: [x] if x < 100 else known.setdefault(x, expand(int(rules[x - 100][0])) + expand(int(rules[x - 100][1])))
    for x in symbols.tolist():
        out += expand(x)
    assert out == ids.tolist() and len(symbols) < len(ids) / 2
    assert [len(expand(100 + i)) for i in range(len(rules))] == repair.lengths_of(rules, 100).tolist()


def test_grammar_counts_few_places_again(monkeypatch):
    draw = np.random.default_rng(8)
    parts = [draw.integers(3, 200, draw.integers(1, 6)) for _ in range(3000)]
    ids = np.concatenate([np.append(np.concatenate([parts[i] for i in draw.zipf(1.3, 40) % 3000]), 2) for _ in range(2000)])
    count, seen = np.bincount, []
    monkeypatch.setattr(np, "bincount", lambda x, **more: seen.append(len(x)) or count(x, **more))
    symbols, rules = repair.compress(ids, 2, 1000)
    assert len(rules) and sum(seen) < 6 * len(ids)


@pytest.mark.parametrize("width,most", [(2, 1 << 18), (4, 1 << 20), (8, 1 << 24), (16, 1 << 32)])
def test_symbols_of_all_widths(width, most):
    symbols = np.random.default_rng(width).integers(0, most, 1003).astype(np.uint32)
    shard = object.__new__(repair.Shard)
    shard.source, shard.symbols_at, shard.n_symbols, shard.bits = io.BytesIO(repair.pack(symbols, width)), 0, 1003, width
    for a, b in ((0, 1003), (5, 6), (7, 1000), (3, 3)):
        assert (shard.symbols(a, b) == symbols[a:b]).all()


def test_grammar_is_smaller_and_random_access_is_exact():
    draw = np.random.default_rng(4)
    motifs = draw.integers(3, 40, (5, 6))
    docs = [np.append(np.tile(motifs[i % 5], draw.integers(1, 60)), 2) for i in range(200)]
    ids = np.concatenate(docs).astype(np.uint32)
    shard = repair.Shard(io.BytesIO(repair.build(list(range(200)), np.array(list(map(len, docs))), ids, 2, 50257)))
    assert shard.n_symbols < len(ids) / 2 and shard.n_rules
    assert (shard.all() == ids).all()
    assert all((shard.document(i) == d).all() for i, d in enumerate(docs))


def test_archives_round_trip(spark):
    rows = [(i, f"http://h/{i}", t) for i, t in enumerate(["<p>a</p>", "", None, "é\r\n\r\nx", "<p>a</p>", "b" * 300_000])]
    rows += [(100 + i, None, "same") for i in range(50)]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, first string")
    manifest = archives.write_archives(pages, files.folder(spark, "warc"), archive_bytes=2000)
    got = {r.page_id: r for r in archives.read_archives(manifest).collect()}
    first = {}
    for key, _, html in sorted(rows, key=lambda r: r[0]):
        first.setdefault(html or "", key)
    for key, url, html in rows:
        r, body = got[key], (html or "").encode()
        to = first[html or ""]
        assert (r.payload_bytes, r.payload_digest) == (len(body), archives.sha1_base32(body))
        assert (r.record_type, r.refers_to) == (("response", None) if to == key else ("revisit", to))
        assert r.payload is None if to != key else bytes(r.payload) == body
        assert r.url == (url or "")
    few = archives.read_archives(archives.write_archives(pages, files.folder(spark, "warc"), least_bytes=5))
    assert {r.page_id for r in few.collect() if r.record_type == "revisit"} == {4}
    assert archives.read_archives(archives.write_archives(pages.limit(0), files.folder(spark, "warc"))).count() == 0


@pytest.mark.parametrize("hot", [common.HOT, 3, 1])
def test_archives_of_missing_and_repeated_keys(spark, monkeypatch, hot):
    # Payloads that stay in place, that are moved by their digest, and both.
    monkeypatch.setattr(common, "HOT", hot)
    rows = [(None, "a"), (3, "a"), (None, "a"), (2, "a"), (2, "a"), (2, "b"), (1, "b"), (3, "c"), (3, "c"), (None, "d"), (None, "d"), (None, None), (7, "e"), (7, "f")]
    pages = spark.createDataFrame([(k, "u", t) for k, t in rows], "page_id long, url string, html string")
    got = archives.read_archives(archives.write_archives(pages, files.folder(spark, "warc"))).collect()
    want = []
    for key, html in rows:
        to = min((k for k, h in rows if h == html and k is not None), default=None)
        response = to is None or key == to
        want.append((key, len(html or ""), "response" if response else "revisit", None if response else to, (html or "").encode() if response else None))
    found = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("zip64", [False, True])
def test_zip_as_the_standard_library(zip64):
    data = archives.pack([("a.txt", b"one"), ("dir/b", b"two" * 100)], zip64)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and z.read("dir/b") == b"two" * 100
    other = io.BytesIO()
    with zipfile.ZipFile(other, "w") as z:
        with z.open("a.txt", "w", force_zip64=zip64) as out:
            out.write(b"one")
        z.comment = b"with a comment"
    for raw in (data, other.getvalue()):

        class Source(io.BytesIO):
            def size(self, n=len(raw)):
                return n

        archive = archives.Archive(Source(raw))
        assert archive.part("a.txt") == b"one" and archive.part("a.txt", 1, 1) == b"n"
        with pytest.raises(ValueError):
            archive.part("a.txt", 2, 5)
    with pytest.raises(ValueError):
        archives.Archive(Source(b"no archive"))


def test_quality_on_held_out_labels(spark, small):
    larger = small.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{larger}/{t}.parquet") for t in ("documents", "labels"))
    rows = preference.score(docs, preference.learn(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_quality_without_labels_or_texts(spark, docs_of):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    docs = docs_of([(1, None), (2, ""), (None, "a"), (2, "")])
    rows = preference.score(docs, preference.learn(docs, none), carry=True).collect()
    assert [r.score for r in rows] == [0.5] * 4 and {r.row.salt for r in rows} == {"x"}
    assert preference.score(docs_of([]), preference.NOTHING_LEARNED).count() == 0


def test_strengths_are_those_of_a_plain_solver():
    """The pair loss of the fit against that of plain gradient descent on the same pairs."""
    draw = np.random.default_rng(21)
    x = draw.standard_normal((300, len(preference.FEATURES)))
    good = x[:, 0] - 2 * x[:, 1] + draw.standard_normal(300) > 0
    strength = preference.fit(x, good)
    z = (x - x.mean(0)) / x.std(0)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    n = preference.PAIRS_PER_ROW * max(len(better), len(worse))
    pairs = z[better[np.arange(n) % len(better)]] - z[np.random.default_rng(7).choice(worse, n)]
    loss = lambda w: np.logaddexp(0, -pairs @ w).mean() + 1e-3 / 2 * w @ w
    w = np.zeros(z.shape[1])
    for _ in range(3000):
        w += 0.2 * (pairs.T @ (1 / (1 + np.exp(pairs @ w))) / n - 1e-3 * w)
    assert abs(loss(strength.weights) - loss(w)) < 1e-6
    assert np.abs(strength.weights - w).max() < 0.02
    # The threshold: no other cut of the strengths gives less balanced error.
    s = strength.of(x)
    error = lambda t: (s[good] < t).mean() + (s[~good] >= t).mean()
    assert error(strength.threshold) <= min(error(t) for t in s) + 1e-12


def test_preferences_order_strengths():
    draw = np.random.default_rng(1)
    x = draw.standard_normal((400, len(preference.FEATURES)))
    good = x[:, 0] + 0.3 * draw.standard_normal(400) > -0.8
    strength = preference.fit(x, good)
    assert np.corrcoef(strength.of(x), x[:, 0])[0, 1] > 0.9
    assert ((strength.score(x) >= preference.CUT) == good).mean() > 0.85


ITEM = "Which river crosses the old harbour town before the quiet northern lake. The answer names seven painted bridges of Alderny"


def test_benchmark_items_and_paraphrases(spark, docs_of):
    draw = random.Random(6)
    filler = lambda n: " ".join("".join(draw.choice("bcdfgh") + draw.choice("aeiou") for _ in range(3)) for _ in range(n))
    changed = ITEM.replace("old", "former").replace("quiet", "calm").upper()
    rows = [(i, filler(150)) for i in range(60)]
    rows += [(100, f"{filler(90)} {ITEM} {filler(70)}"), (101, f"{filler(33)}, {changed}! {filler(10)}"), (102, ITEM)]
    rows += [(103, " ".join(draw.sample(ITEM.split(), len(ITEM.split())))), (104, None), (105, "")]
    items = [(1, ITEM), (2, None), (3, ""), (4, filler(30))]
    benchmark = spark.createDataFrame([(*i, "c") for i in items], "item_id long, text string, cosine string")
    got = latent.find_items(docs_of(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(100, 1), (101, 1), (102, 1)}
    assert latent.find_items(docs_of([]), benchmark).count() == 0
    assert latent.find_items(docs_of(rows), benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("size", [130, 300])
def test_a_long_benchmark_item(spark, docs_of, size):
    draw = random.Random(size)
    filler = lambda n: " ".join("".join(draw.choice("bcdfgh") + draw.choice("aeiou") for _ in range(4)) for _ in range(n))
    item = filler(size)
    changed = item.split()
    changed[20::25] = [filler(1) for _ in changed[20::25]]
    rows = [(i, filler(150)) for i in range(60)] + [(103, " ".join(item.split()[: size // 2]))]
    rows += [(100, f"{filler(90)} {item} {filler(70)}"), (101, item), (102, f"{filler(17)} {' '.join(changed)}")]
    benchmark = spark.createDataFrame([(1, item), (2, filler(20))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in latent.find_items(docs_of(rows), benchmark).collect()}
    assert set(got) == {(100, 1), (101, 1), (102, 1)}
    assert got[100, 1].lcs == got[101, 1].lcs == got[100, 1].answer == 1


def test_common_subsequence():
    draw = random.Random(7)
    for _ in range(200):
        a = [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(1, 12))]
        b = [draw.choice([b"a", b"b", b"c", b"d"]) for _ in range(draw.randint(0, 12))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        masks = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | 1 << i
        assert latent.common_subsequence(masks, len(a), b) == table[-1][-1]


def test_directions_are_the_leading_singular_vectors(spark):
    rows = [(t,) for t in (["a b c", "a b", "c d", "d e f", "a b c d", "e f", "x y"] * 3)]
    docs = spark.createDataFrame(rows, "text string")
    items = latent.Items.of([(1, "a b c d e f.")])
    weight = np.ones(6)
    found = latent.directions(latent._occurrences(docs, items, weight, "text"), items, weight, rank=2, power=8)
    dense = np.array([[t[0].split().count(w) for w in "abcdef"] for t in rows], float)
    dense = np.vstack([latent._unit(dense[dense.any(axis=1)]), items.rows(weight) * np.sqrt(18)])
    want = np.linalg.svd(dense, full_matrices=False)[2][:2]
    assert np.allclose(np.abs(want @ found), np.eye(2), atol=1e-3)


def test_regex_of_the_base_rules_is_as_stated():
    assert re.fullmatch(secrets.BASE[2].pattern, "0123456789abcdef")
