import hashlib
import random
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from martlet.llm import poisson_mix, surrogates
from martlet.llm.tokens import VOCABULARY
from test_ngram_join import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    r = random.Random(3)
    words = {"en": "the of and house river walk over green with from quiet people there".split(),
             "de": "der die und haus fluss grün mit von ruhig menschen dort gehen über".split()}
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "de"
        text = " ".join(r.choices(words[lang], k=r.randint(20, 60)))
        rows.append((i, text + (f" ask ann{i}@mail.example.com or 10.1.2.{i}" if i % 7 == 0 else ""), lang, f"s{i % 4}"))
    rows += [(100 + i, rows[5][1] + (" " if i else ""), "en", "s1") for i in range(4)]
    rows += [(200, "12345 678", "en", "s2"), (201, None, "en", "s2"), (202, "", None, None)]
    return [(*x, len(x[1] or "")) for x in rows]


def test_stages_equal_brute_force(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, str(tmp_path))
        after.write.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert after.columns == docs.columns
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
    # Only the documents without letters go.
    assert {r.doc_id for r in seen["language"]} == {r[0] for r in rows} - {200, 201, 202}
    classes = defaultdict(list)
    kept = [(r[0], r[1], 0) for r in rows if r[0] < 200]
    for doc_id, _, component in brute(kept, 5, 80, 100):
        classes[component].append(doc_id)
    assert sorted(r.doc_id for r in seen["near_duplicates"]) == sorted(classes) and 100 not in classes
    before = {r.doc_id: r.text for r in seen["near_duplicates"]}
    for r in seen["private_data"]:
        found = surrogates.entities(before[r.doc_id])
        assert len(found) == (2 if r.doc_id % 7 == 0 else 0) and r.n_chars == len(r.text)
        assert (r.text == before[r.doc_id]) == (not found)
        assert not any(normal in r.text for *_, normal in found)
    texts = {r.doc_id: r for r in seen["private_data"]}
    copies = defaultdict(int)
    for r in seen["mixing"]:
        assert r == texts[r.doc_id]
        copies[r.doc_id] += 1
    sizes = defaultdict(int)
    for r in texts.values():
        sizes[r.source] += len(r.text.encode())
    weight = sum(v**0.5 for v in sizes.values())
    for r in texts.values():
        rate = sum(sizes.values()) * sizes[r.source]**0.5 / weight / sizes[r.source]
        digits = hashlib.md5(f"0:count|{r.doc_id}|{r.text}".encode()).hexdigest()[:13]
        u = (int(digits, 16) + 0.5) / 2**52
        assert copies[r.doc_id] == int((poisson_mix.poisson_steps(rate) < u).sum())
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokens = defaultdict(int)
    for r in seen["packing"]:
        tokens[r.doc_id] += len(np.frombuffer(r.ids, "<u4"))
    assert dict(tokens) == {
        i: n * (len(tokenizer.encode(texts[i].text, add_special_tokens=False).ids) + 1) for i, n in copies.items() if n}


def test_run_and_an_empty_table(spark, tmp_path):
    spark.createDataFrame(documents()[:12], SCHEMA).write.parquet(f"{tmp_path}/a/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/a").count() > 0
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0
