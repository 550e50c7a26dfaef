"""Stages and all operators on odd rows, against plain Python."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_simhash import brute as fingerprint
from tests.llm.test_simhash import brute_components
from weftline.llm import decontaminate, exactdedup, htmltext, langid, licenses, packing, repeats, simhash, tokenfile, toxicity

ODD = [
    (1, None, None, "s", 0), (2, "", "en", None, 0), (3, "  ", "en", "s", 2), (4, "same text here and there", "en", "s", 1), (5, "same text here and there", "en", "s", 1),
    (5, "same text here and there", "en", "s", 1), (5, "another text of the same id", "en", "s", 1), (None, "a null id and some words", "en", "s", 1), (None, None, None, None, None), (-7, "x" * 200_000, "en", "s", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_rows(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, SCHEMA)
    for clash in ("keep_id", "component_id", "fp", "id", "n", "key", "digest", "score", "start", "items", "token", "_own", "_score", "_lang", "_stay", "lang_pred", "lang_score", "group", "size", "stay"):
        docs = docs.withColumn(clash, docs.n_chars)
    bench = spark.createDataFrame([(1, "same text here and there"), (None, None)], "item_id long, text string")
    labels = spark.createDataFrame([(2, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    n = len(rows)
    assert exactdedup.duplicate_groups(docs).count() == n
    assert simhash.near_duplicates(docs).count() == n
    assert decontaminate.contamination(docs, bench).count() == n
    assert langid.classify(docs, langid.train(docs)).count() == n
    assert toxicity.scored(docs, toxicity.train(docs, labels)).count() == n
    assert sum(r.length for r in packing.packed(docs, public_tokenizers.path("word_bpe_49k.json")).collect()) >= n
    assert repeats.without_repeats(docs).count() == n
    assert licenses.licenses(docs).count() == 0
    tokenfile.write_tokens(docs, str(tmp_path / "file"), public_tokenizers.path("byte_bpe_50k.json"))
    assert tokenfile.read_tokens(spark, str(tmp_path / "file")).count() == n
    pages = docs.withColumnRenamed("doc_id", "page_id").withColumnsRenamed({"text": "html", "source": "url"})
    assert htmltext.extract(pages).count() == n
    for name, stage in (("exact", lambda: exactdedup.without_copies(docs)), ("near", lambda: simhash.one_of_each(docs)), ("clean", lambda: decontaminate.decontaminated(docs, bench)), ("language", lambda: langid.accepted(docs))):
        out = stage()
        assert out.columns == docs.columns, name
        out.collect()
    if rows:
        kept = exactdedup.without_copies(docs).collect()
        assert sorted((r.text or "") for r in kept) == sorted({r[1] or "" for r in rows})
        assert not [r for r in decontaminate.decontaminated(docs, bench).collect() if r.text == rows[3][1]]


def test_pipeline(spark, tmp_path):
    rng = random.Random(9)
    make = {"en": ["the", "ing", "tion", "er"], "fr": ["eau", "é", "oi", "ment"]}
    word = lambda x: "".join(rng.choice(make[x]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(120):
        x = rng.choice(["en", "fr"])
        rows.append((i, " ".join(word(x) for _ in range(rng.randint(30, 80))), x, "s", 1))
    bench = [(i, " ".join(word("en") for _ in range(15))) for i in range(3)]
    rows += [(200 + i, rows[i][1], rows[i][2], "s", 1) for i in range(20)]  # copies
    rows += [(300 + i, rows[20 + i][1] + " " + bench[i % 3][1], "en", "s", 1) for i in range(6)]
    rows += [(400, "12 34 --- 56", None, "s", 1), (401, None, None, "s", 1)]
    pq.write_table(pa.Table.from_pylist([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]), f"{tmp_path}/documents.parquet")
    pq.write_table(pa.table({"item_id": [b[0] for b in bench], "text": [b[1] for b in bench]}), f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    model = langid.train(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    lang, score = model.predict(pa.array([r[1] for r in docs]))
    docs = [r for r, s in zip(docs, score) if s >= model.reject_below]
    assert len(docs) >= len(rows) - 4
    docs = [r for r in docs if r[0] == max(q[0] for q in docs if q[1] == r[1])]
    comp = brute_components([r[0] for r in docs], [fingerprint(r[1]) for r in docs])
    docs = [r for r, c in zip(docs, comp) if r[0] == c]
    hit = {h[0] for h in hits([(r[0], r[1]) for r in docs], bench) if h[-1]}
    docs = [r for r in docs if r[0] not in hit]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r[0]: [*t.encode(r[1], add_special_tokens=False).ids, 1] for r in docs}
    assert hit and {r.doc_id for r in got} == set(want)
    for r in got:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and r.doc_tokens == len(want[r.doc_id])
    assert sum(r.length for r in got) == sum(map(len, want.values()))
