"""The pipeline on a small fixture, stage by stage against brute force; op8 on held-out rows."""

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from ringtrail.llm import queries
from tests.llm.test_operators import BLANK, _classes, _fingerprint, order

KINDS = "doc_id long, text string, lang string, source string, n_chars long"


def same(text):
    return re.sub(BLANK, "", text or "")


def fixture(spark, folder):
    pick = random.Random(12)
    common, foul = [f"word{i}" for i in range(400)], [f"foul{i}" for i in range(6)]
    say = lambda n: " ".join(pick.choice(common) for _ in range(n))
    toxic = lambda: " ".join(pick.sample([*foul, *say(6).split()], 12))
    texts = [toxic() if i % 3 == 0 else say(pick.randint(20, 60)) for i in range(240)]
    items = [say(16) + ". " + say(8) for _ in range(4)]
    leaked = [f"{say(30)} {x} {say(30)}" for x in items]
    long = say(400)
    copies = [texts[1], texts[1].replace(" ", "  "), long, long + " changed", long.replace(" ", "\n")]
    rows = list(enumerate([*texts, *leaked, *copies, "", None, "  "]))
    rows += [rows[1], rows[2], rows[3], (None, texts[4]), (None, say(30)), (None, None), (5, say(25)), (None, leaked[0])]
    pick.shuffle(rows)
    docs = [(i, t, "en", None if n % 5 else "s", n) for n, (i, t) in enumerate(rows)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(240)]
    spark.createDataFrame(docs, KINDS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return items


def test_pipeline_stage_by_stage(spark, tmp_path, monkeypatch):
    import public_tokenizers
    import tiktoken

    folder = str(tmp_path)
    items = fixture(spark, folder)
    docs = queries.table(spark, folder, "documents")
    model = queries.toxicity_model(docs, queries.table(spark, folder, "labels"))
    seen = []
    write = corpus_pipeline.staged

    def kept(table, purpose):
        out = write(table, purpose)
        seen.append((purpose, out.columns, [tuple(r) for r in out.collect()]))
        return out

    monkeypatch.setattr(corpus_pipeline, "staged", kept)
    final = corpus_pipeline.run(spark, folder).collect()
    assert [s[0] for s in seen] == ["toxicity", "exact-dedup", "SimHash-near-dedup", "benchmark-decontamination"]
    assert all(columns == docs.columns for _, columns, _ in seen)
    given = [tuple(r) for r in docs.collect()]
    toxic, exact, near, clean = (rows for *_, rows in seen)

    assert Counter(toxic) == Counter(r for r in given if model.judge(r[1] or "")[0] < 0.7)
    assert 60 < len(given) - len(toxic) < 100

    best = {}
    for r in toxic:
        key = (-len(r[1] or ""), order(r[0]))
        best[same(r[1])] = min(best.get(same(r[1]), key), key)
    assert Counter((same(r[1]), (-len(r[1] or ""), order(r[0]))) for r in exact) == Counter(best.items())
    assert set(exact) <= set(toxic) and len(exact) < len(toxic)

    found = _classes({_fingerprint(r[1]) for r in exact}, 3)
    least = {}
    for r in exact:
        own = found[_fingerprint(r[1])]
        least[own] = min(least.get(own, order(None)), order(r[0]))
    assert Counter((found[_fingerprint(r[1])], order(r[0])) for r in near) == Counter(least.items())
    assert set(near) <= set(exact) and len(near) < len(exact)

    plain = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    assert Counter(clean) == Counter(r for r in near if not any(plain(x) in plain(r[1]) for x in items))
    assert len(near) - len(clean) >= len(items)

    ranks, pattern = queries.vocabulary()
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=queries.byte_bpe.Codec(ranks, pattern).ranks,
        special_tokens={},
    )
    want = []
    for r in clean:
        ids = library.encode_ordinary(r[1] or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        digests = [hashlib.sha256(x).hexdigest() for x in (packed, (r[1] or "").encode())]
        want.append((r[0], len(ids), *digests))
    assert Counter(tuple(r) for r in final) == Counter(want)


def test_held_out_language(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    got = queries.op8_language(spark, folder).join(docs.where("lang is not null"), "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    print("held-out language", right, n)
    assert n > 50 and right >= 0.9
