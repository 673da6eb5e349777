"""The registered queries and the pipeline over given tables."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.check import differences, duck
from wearline.llm import latent, secrets
from wearline.llm.oracles import ORACLES

from .test_pairs import near_classes, plain_print
from .test_texts import spans_by_re


@pytest.fixture(scope="module")
def documents(small):
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet'").fetchall())


def rows(spark, small, name):
    return {r.doc_id: r for r in entry.queries()[name](spark, small).collect()}


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, small, name):
    assert differences(spark, duck(small), small, name) is None


def test_all_operators_are_registered():
    found = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert found == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()


def test_fingerprint_query(spark, small, documents):
    got = rows(spark, small, "op4_simhash")
    assert {k: r.fingerprint for k, r in got.items()} == {k: f"{plain_print(t):016x}" for k, t in documents.items()}


def test_piece_query(spark, small, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = rows(spark, small, "op5_sentencepiece")
    for key, text in documents.items():
        ids = library.encode(text)
        assert got[key].n_tokens == len(ids)
        assert got[key].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[key].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_token_file_query(spark, small, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, start = rows(spark, small, "op6_repair"), 0
    for key in sorted(documents):
        ids = library.encode(documents[key], add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (got[key].start, got[key].n_tokens, got[key].ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_secret_query(spark, small, documents):
    got = rows(spark, small, "op9_secrets")
    for key, text in documents.items():
        base = spans_by_re(text.encode(), secrets.BASE)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert got[key].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[key][f"n_{k}"] for k in ("assign", "access", "hex")] == [
            sum(s[0] == k for s in base) for k in ("assign", "access", "hex")
        ]


def test_benchmark_query_finds_whole_items(spark, small):
    wanted = duckdb.sql(
        f"SELECT DISTINCT doc_id, item_id FROM '{small}/documents.parquet' d, '{small}/benchmark.parquet' b "
        "WHERE contains(d.text, b.text)"
    ).fetchall()
    got = {(r.doc_id, r.item_id) for r in entry.queries()["op1_latent"](spark, small).collect()}
    assert set(wanted) <= got and len(got) <= len(wanted) + 1


def test_pipeline_keeps_clean_texts_and_drops_the_rest(spark, tmp_path):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("bcdfglmnprst") + draw.choice("aeiou") for _ in range(3))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    prose = lambda n: " ".join(sentence(draw.randint(5, 15)) for _ in range(-(-n // 10)))
    texts = {i: prose(draw.randint(60, 300)) for i in range(80)}
    junk = {200 + i: " ".join(w + draw.choice(["###", "$$$", "!!"]) for w in prose(draw.randint(60, 300)).upper().split()) for i in range(30)}
    texts |= {80 + i: f"{prose(90)} key = {i}; a = b_{i} {prose(60)}" for i in range(10)}
    item = sentence(30)
    near = texts[5].split()
    near[-1] = "changed"
    extra = {
        100: texts[3],
        101: " ".join(near),
        102: f"{prose(40)} {item} {prose(40)}",
        103: f"{prose(60)} token = 'abcdefabcdef0123' {prose(40)}",
        104: "",
        105: None,
    }
    docs = texts | junk | extra
    given = [(k, t, "en", "s", len(t or "")) for k, t in docs.items()]
    spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, int(k not in junk), 0) for k in [*texts, *junk]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names, left = kept.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, str(tmp_path))
        if name != "tokens":
            assert kept.columns == names
        left[name] = {r.doc_id: r for r in kept.collect()}
        kept = spark.createDataFrame(list(left[name].values()), kept.schema)
    assert not set(junk) & set(left["quality"]) and {*texts, 100, 101, 102, 103} <= set(left["quality"])
    rows = sorted((k, r.text) for k, r in left["quality"].items())
    first = near_classes(rows)
    assert set(left["near_copies"]) == {rows[i][0] for i in first.values()}
    assert 100 not in left["near_copies"] and {*texts, 102, 103} <= set(left["near_copies"])
    assert set(left["near_copies"]) - set(left["decontamination"]) == {102}
    assert set(left["secrets"]) == set(left["tokens"]) == set(left["decontamination"])
    assert "[assign+hex]" in left["secrets"][103].text and left["secrets"][7].text == texts[7]
    assert set(texts) <= set(left["tokens"]) and left["tokens"][7].n_tokens > 100


def test_decontamination_judges_rows_not_ids(spark, tmp_path, docs_of):
    draw = random.Random(5)
    filler = lambda n: " ".join("".join(draw.choice("bcdfgh") + draw.choice("aeiou") for _ in range(3)) for _ in range(n))
    item = filler(30)
    rows = [(i, filler(100)) for i in range(40)] + [(None, filler(80)), (None, f"{filler(40)} {item}"), (None, None)]
    rows += [(50, filler(80)), (50, f"{item} {filler(40)}"), (50, filler(60))]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = docs_of(rows)
    kept = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    want = [r for r in rows if item not in (r[1] or "")]
    assert len(want) == len(rows) - 2
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=order) == sorted(want, key=order)


def test_benchmark_items_without_a_key_or_repeated(spark, docs_of):
    draw = random.Random(6)
    filler = lambda n: " ".join("".join(draw.choice("bcdfgh") + draw.choice("aeiou") for _ in range(3)) for _ in range(n))
    items = [(None, filler(30)), (3, filler(30)), (3, filler(25)), (None, None), (4, "")]
    items += [items[1], items[0]]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("cosine", F.lit("x"))
    rows = [(i, filler(100)) for i in range(30)] + [(50 + i, f"{filler(20)} {t} {filler(20)}") for i, (_, t) in enumerate(items[:3])]
    got = sorted(((r.doc_id, r.item_id) for r in latent.find_items(docs_of(rows), benchmark).collect()), key=str)
    assert got == [(50, None), (51, 3), (52, 3)]
    kept = latent.without_items(docs_of(rows), benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(30))


def test_benchmark_query_finds_what_a_plain_search_does(spark, small, documents):
    """Every passage against every item: words in order, then the answer, as the operator asks."""
    items = duckdb.sql(f"SELECT item_id, text FROM '{small}/benchmark.parquet'").fetchall()
    known = latent.Items.of(items)
    masks = [{w: sum(1 << i for i, x in enumerate(words) if x == w) for w in words} for words in known.words]
    want = set()
    for key, text in documents.items():
        words = latent.words_of((text or "").encode())
        for start in range(0, max(1, len(words) - latent.STRIDE), latent.STRIDE):
            around = words[max(0, start - latent.STRIDE // 2) : start + latent.PASSAGE + latent.STRIDE // 2]
            there = set(around)
            for item, mask, own, answer in zip(known.keys, masks, known.words, known.answers):
                if sum(w in there for w in own) < latent.LCS * len(own):
                    continue
                share = latent.common_subsequence(mask, len(own), around) / len(own)
                if share >= latent.LCS_ALONE or share >= latent.LCS and sum(w in there for w in answer) >= len(answer) / 2:
                    want.add((key, item))
    got = {(r.doc_id, r.item_id) for r in entry.queries()["op1_latent"](spark, small).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and want


def test_pipeline_of_no_documents(spark, small, docs_of):
    kept = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, small)
        assert kept.count() == 0
