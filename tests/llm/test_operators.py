"""Every operator on awkward rows, against brute force where there is one."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ringtrail.llm import (
    byte_bpe,
    components,
    decontaminate,
    exact_dedup,
    language,
    quality,
    simhash,
    substring_dedup,
    suffix_array,
    toxicity,
    url_filter,
)
from ringtrail.llm.rows import labelled_sample

BLANK = r"[\x20\x09-\x0D]+"
KINDS = "doc_id long, text string, lang string, source string, n_chars long, row long, doc string, score string, kept string"


def _texts():
    pick = random.Random(5)
    words = ["".join(pick.choice("abcdeé漢") for _ in range(pick.randint(1, 6))) for _ in range(300)]
    say = lambda n: " ".join(pick.choice(words) for _ in range(n))
    passage, line = say(60), say(20)
    texts = [say(pick.randint(1, 120)) for _ in range(30)]
    texts += [say(40) + " " + passage + "\n" + say(30) for _ in range(6)]
    texts += [line + "\t" + say(3) + "\n" + line + " " + say(5) for _ in range(5)]
    texts += [passage, passage, passage.replace(" ", "\n"), " " + passage, "", None, "   ", "?!", "x", "A b"]
    near = say(200).split()
    for i in range(8):
        near[20 * i] = "changed"
        texts.append(" ".join(near))
    texts += ["aaaa" * 100, "ab " * 300, say(20_000)]
    return texts


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t) for i, t in enumerate(_texts())]
    rows += [rows[3], rows[3], (None, rows[4][1]), (None, None), (None, rows[31][1]), (7, "other text for an id seen")]
    random.Random(1).shuffle(rows)
    full = [
        (i, t, ["en", "de", None][n % 3], None, n, n, "d", "s", None) for n, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, KINDS).repartition(3).cache()


def pairs(awkward):
    return [(r["doc_id"], r["text"]) for r in awkward.collect()]


def order(i):
    return (1 << 63) - 1 if i is None else i


def test_empty_tables_give_no_rows(spark):
    docs = spark.createDataFrame([], KINDS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    learn = F.lit(True)
    for got in (
        quality.score(docs, quality.fit(docs, labels, learn)),
        toxicity.score(docs, toxicity.fit(docs, labels, learn)),
        language.predict(docs, language.fit(docs, learn)),
        exact_dedup.resolve(docs),
        simhash.near_duplicates(docs),
        substring_dedup.remove_repeats(docs),
        suffix_array.remove_repeats(docs),
        url_filter.judge(pages, [url_filter.Rule("allow", "org/")]),
        decontaminate.leaks(docs, []),
    ):
        assert got.count() == 0
    assert exact_dedup.deduplicate(docs).columns == docs.columns
    assert simhash.deduplicate(docs).count() == 0


def test_exact_dedup(awkward):
    same = lambda t: re.sub(BLANK, "", t or "")
    rows = pairs(awkward)
    for heavy_rows in (2, 100):
        got = exact_dedup.resolve(awkward, heavy_rows=heavy_rows).collect()
        assert len(got) == len(rows)
        for digest in {r["text_sha256"] for r in got}:
            group = [x for x in rows if hashlib.sha256(same(x[1]).encode()).hexdigest() == digest]
            best = min(group, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))
            mine = [r for r in got if r["text_sha256"] == digest]
            assert {(r["keep_id"], r["group_size"]) for r in mine} == {(best[0], len(group))}
            assert [r["doc_id"] for r in mine if r["kept"]] == [best[0]]
    kept = exact_dedup.deduplicate(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len({same(t) for _, t in rows})


def _fingerprint(text):
    words = [w for w in re.split(BLANK, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _classes(points, budget, linked=lambda a, b: True):
    """Class of each point by comparing all pairs."""
    points = sorted(points)
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= budget and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in points}


@pytest.mark.parametrize("max_group", [20_000, 2])
def test_simhash(spark, awkward, max_group):
    rows = [(i, _fingerprint(t)) for i, t in pairs(awkward)]
    found = _classes({p for _, p in rows}, 3)
    least = {}
    for i, p in rows:
        least[found[p]] = min(least.get(found[p], (True, 0)), (i is None, i or 0))
    want = sorted((order(i), p, order(None if least[found[p]][0] else least[found[p]][1])) for i, p in rows)
    prints = simhash.fingerprints(F.col("n_chars"), awkward, F.col("doc_id"), F.col("text"), 3)
    got = simhash.classes(prints, 3, max_group).collect()
    assert want == sorted(
        (order(r["doc_id"]), r["fp"] & (1 << 64) - 1, order(r["first"]["doc_id"])) for r in got
    )
    assert simhash.deduplicate(awkward).count() == len(set(found.values()))


def test_trie_finds_all_links():
    pick = np.random.default_rng(0)
    for budget in (0, 1, 2, 3):
        for _ in range(10):
            base = pick.integers(0, 2**63, 4, dtype=np.uint64)
            points = base[pick.integers(0, 4, 80)]
            for i in range(80):
                for bit in pick.integers(0, 64, pick.integers(0, 5)):
                    points[i] ^= np.uint64(1) << np.uint64(bit)
            points = np.unique(points)
            a, b = simhash.forest(np.zeros(len(points), int), points, budget)
            tied = {(int(x), int(y)) for x, y in zip(a, b)}
            mine = _classes(map(int, points), 64, lambda x, y: (x, y) in tied or (y, x) in tied)
            assert mine == _classes(map(int, points), budget)


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(500, i) for i in range(100, 300)] + [(7, 7)]
    got = components.components(spark.createDataFrame(chain, "a long, b long"))
    want = {i: 1 for i in range(2, 61)} | {i: 100 for i in [*range(101, 300), 500]}
    assert {r["node"]: r["root"] for r in got.collect()} == want


def test_substring_dedup(awkward):
    window, rows = 13, pairs(awkward)
    split = [[w for w in re.split(BLANK, t or "") if w] for _, t in rows]
    first = {}
    for (i, _), words in zip(rows, split):
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            first[key] = min(first.get(key, order(None)), order(i))
    want = []
    for (i, _), words in zip(rows, split):
        gone = set()
        for p in range(len(words) - window + 1):
            if first[tuple(words[p : p + window])] < order(i):
                gone.update(range(p, p + window))
        kept = " ".join(w for n, w in enumerate(words) if n not in gone)
        want.append((order(i), len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = [
        (
            order(r["doc_id"]),
            r["n_words"],
            sum(s["end"] - s["begin"] for s in r["spans"] or []),
            r["words_sha256"] if r["kept"] is None else hashlib.sha256(r["kept"]).hexdigest(),
        )
        for r in substring_dedup.remove_repeats(awkward, window).collect()
    ]
    assert sorted(got) == sorted(want)


def test_longest_passages(spark):
    words = [f"w{i}" for i in range(400)]
    docs = [(1, " ".join(words[:120])), (2, " ".join(["x"] + words[10:100])), (3, " ".join(words[5:20]))]
    texts = spark.createDataFrame(
        [(i, i, t.encode()) for i, t in docs], "row long, order long, body binary"
    )
    got = {r["row"]: r["n_words"] for r in substring_dedup.longest_passages(texts, 13).collect()}
    assert got == {1: 52, 2: 52, 3: 13}


@pytest.mark.parametrize("hot_rows", [50_000, 3])
def test_suffix_array(awkward, hot_rows):
    window, rows = 100, [(i, (t or "").encode()) for i, t in pairs(awkward) if len(t or "") < 50_000]
    docs = awkward.where("text is null or length(text) < 50000")
    first = {}
    for i, t in rows:
        for p in range(len(t) - window + 1):
            first[t[p : p + window]] = min(first.get(t[p : p + window], order(None)), order(i))
    want = []
    for i, t in rows:
        gone, seen = np.zeros(len(t), bool), set()
        for p in range(len(t) - window + 1):
            key = t[p : p + window]
            if first[key] < order(i) or key in seen:
                gone[p : p + window] = True
            seen.add(key)
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()
        want.append((order(i), len(t), int(gone.sum()), spans, kept))
    got = [
        (
            order(r["doc_id"]),
            r["n_bytes"],
            sum(s["end"] - s["begin"] for s in r["spans"] or []),
            len(r["spans"] or []),
            r["text_sha256"] if r["kept"] is None else hashlib.sha256(r["kept"]).hexdigest(),
        )
        for r in suffix_array.remove_repeats(docs, window, hot_rows).collect()
    ]
    assert sorted(got) == sorted(want)


def test_buckets_stay_whole_beside_hot_ones(spark, setting):
    # A join that becomes a broadcast at run time must not undo the shuffle by anchor.
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pick = random.Random(11)
    say = lambda n: "".join(pick.choice("abcdefgh ") for _ in range(n))
    passages = [say(300) for _ in range(20)]
    texts = [say(50) + passages[i % 20] + say(50) for i in range(120)] + ["z" * 400, say(9) + "z" * 300]
    window, seen, want = 100, set(), []
    for i, t in enumerate(texts):
        gone = set()
        for p in range(len(t) - window + 1):
            if t[p : p + window] in seen:
                gone |= set(range(p, p + window))
            seen.add(t[p : p + window])
        want.append((i, "".join(c for p, c in enumerate(t) if p not in gone)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = suffix_array.remove_repeats(docs, window, hot_rows=150).collect()
    got = [(r["doc_id"], texts[r["doc_id"]] if r["kept"] is None else r["kept"].decode()) for r in found]
    assert sorted(got) == want


def test_byte_bpe_is_what_the_library_gives(awkward):
    import public_tokenizers
    import tiktoken

    from ringtrail.llm.queries import vocabulary

    ranks, pattern = vocabulary()
    own = byte_bpe.Codec(ranks, pattern)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={}
    )
    coded = byte_bpe.decode(byte_bpe.encode(awkward, ranks, pattern), ranks, pattern)
    got = [(order(r["doc_id"]), list(memoryview(bytes(r["ids"])).cast("I")), bytes(r["decoded"])) for r in coded.collect()]
    want = [(order(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in pairs(awkward)]
    assert sorted(got) == sorted(want)


def test_leaks_against_scores_of_all_items(spark, awkward):
    pick = random.Random(3)
    texts = [t for _, t in pairs(awkward) if t and 20 < len(t.split()) < 300]
    items = [(n, " ".join(t.split()[:25]) + ". " + " ".join(t.split()[25:32])) for n, t in enumerate(texts[:20])]
    items += [(None, None), (99, ""), (98, "alone")]
    own = decontaminate.indexes(spark.createDataFrame(items, "item_id long, text string"))
    (index,) = own
    for _ in range(50):
        terms = sorted(pick.sample(range(len(index.terms)), 40))
        sums = {}
        for t in terms:
            for p in range(index.begin[t], index.begin[t + 1]):
                sums[index.item[p]] = sums.get(index.item[p], 0.0) + index.impact[p]
        assert sorted(i for i, _ in index.wand(terms, 0.2)) == sorted(i for i, s in sums.items() if s >= 0.2)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(awkward, own).collect()}
    flat = lambda t: " ".join(decontaminate.words_of(t or ""))
    inside = {
        (i, n) for i, t in pairs(awkward) for n, x in items if flat(x) and f" {flat(x)} " in f" {flat(t)} "
    }
    assert inside <= got
    left = decontaminate.without_leaks(awkward, own)
    assert left.columns == awkward.columns
    assert not {r["doc_id"] for r in left.collect()} & {i for i, _ in inside if i is not None and i != 7 and i != 3}


def test_nearest_examples_are_exact():
    pick = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    examples = [
        (n, n % 2, pick.choices(words[30 * (n % 2) :][:40], k=pick.randint(1, 12))) for n in range(400)
    ]
    index = toxicity.build(examples, 0.5, 1000)
    vectors = {}
    for i, _, own in examples:
        vectors[i] = dict(zip(*(x.tolist() for x in index.vector(own))))
    for _ in range(60):
        terms, weights = index.vector(pick.choices(words, k=8))
        dot = [
            (sum(w * vectors[i].get(t, 0.0) for t, w in zip(terms.tolist(), weights)), x)
            for x, i in enumerate(index.ids)
        ]
        want = sorted(((s, x) for s, x in dot if s > 0), key=lambda sx: (-round(sx[0], 9), sx[1]))[:10]
        got = index.nearest(terms, weights, 10)
        assert [round(s, 9) for s, _ in got] == [round(s, 9) for s, _ in want]


def test_sample_takes_one_text_for_an_id_that_many_rows_share(spark):
    docs = spark.createDataFrame(
        [(1, f"text {i % 3}") for i in range(50)] + [(2, "b"), (2, None), (3, ""), (None, "c")],
        "doc_id long, text string",
    )
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (None, 1)], "doc_id long, toxic int")
    got = labelled_sample(docs, labels, "toxic", F.col("doc_id").isNotNull(), 10, 100)
    assert sorted((r.doc_id, r.label, r.text) for r in got.collect()) == [(1, 0, "text 0"), (2, 0, "b")]


def test_models_on_awkward_rows(spark, awkward):
    labels = awkward.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    learn = F.lit(True)
    n = awkward.count()
    for got in (
        quality.score(awkward, quality.fit(awkward, labels, learn)),
        toxicity.score(awkward, toxicity.fit(awkward, labels, learn)),
        language.predict(awkward, language.fit(awkward, learn)),
    ):
        scores = [r["score"] for r in got.collect()]
        assert len(scores) == n and all(0.0 <= s <= 1.0 for s in scores)
    assert toxicity.without_toxic(awkward, toxicity.fit(awkward, labels, learn)).columns == awkward.columns
    found = language.predict(awkward, language.fit(awkward, learn)).join(awkward.select("doc_id", "text"), "doc_id")
    for r in found.where("text is null or text in ('', '   ', '?!')").collect():
        assert (r["lang_pred"], r["score"]) == ("und", 0.0)


@pytest.mark.parametrize("name, column, least", [("op1_quality", "quality", 0.9), ("op4_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, column, least):
    from ringtrail.llm.queries import QUERIES

    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = QUERIES[name](spark, folder).join(labels, "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("predicted") == F.col(column)).cast("int")), F.count("*")).first()
    assert n > 50 and right >= least


def test_url_rules_and_spread(spark):
    link = lambda u: f'<p><A class=x href="{u}">y</a>'
    pages = [
        (1, "http://Good.org/a?b", link("https://near.net/x") + link("/own")),
        (2, "https://near.net/x#y", link("//far.net")),
        (3, "https://far.net", None),
        (4, "https://x.bad.com/de/1", ""),
        (5, "http://friend.net/z", link("http://x.bad.com/de/2")),
        (6, "nothing", ""),
        (7, None, ""),
        (8, "http://example.org/es/1", ""),
        (9, "http://example.org/en/15?x", ""),
        (9, "http://example.org/en/15?x", ""),
    ]
    rules = [url_filter.Rule(*r) for r in (
        ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("block", "com/de/"),
    )]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judge(table, rules).collect()}
    assert {i: (r["host"], r["path"], r["rule"], r["verdict"]) for i, r in got.items()} == {
        1: ("good.org", "/a", "org/", "allow"),
        2: ("near.net", "/x", None, "allow"),
        3: ("far.net", "", None, "allow"),
        4: ("x.bad.com", "/de/1", "com/de/", "block"),
        5: ("friend.net", "/z", None, "block"),
        6: ("", "", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("example.org", "/es/1", "example.org/es/", "block"),
        9: ("example.org", "/en/15", "example.org/en/1", "block"),
    }
    assert got[2]["trust"] > got[3]["trust"] > 0 and got[5]["distrust"] > 0
    assert url_filter.judge(table, rules).count() == len(pages)


def test_dictionary_has_a_share_of_every_text():
    pick = random.Random(4)
    texts = [bytes(pick.choices(range(97, 123), k=600)) for _ in range(1500)]
    own = quality.dictionary(texts)
    assert all(t[172:428] in own for t in texts)
    few = quality.dictionary(texts[:3])
    assert len(few) <= quality.DICTIONARY and all(t in few for t in texts[:3])
    # The compressor finds the first text as well as the last.
    model = quality.Model(own, b"")
    assert min(model.difference(texts[0][172:428]), model.difference(texts[-1][172:428])) > 0.4


def test_distrust_reaches_the_end_of_a_chain(spark):
    n = 19
    pages = [(0, "http://h0.net/bad/x", "")]
    pages += [(i, f"http://h{i}.net/p", f'<a href="http://h{i - 1}.net/">y</a>') for i in range(1, n)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judge(table, [url_filter.Rule("block", "net/bad/")]).collect()}
    for i in range(n):
        assert abs(got[i]["distrust"] - 0.85**i) < 1e-6
        assert got[i]["verdict"] == ("block" if 0.85**i >= 0.05 else "allow")


def test_sql_of_url_filter_on_linked_hosts(spark, tmp_path):
    """A chain of 30 hosts below a blocked one, and a few circles."""
    from ringtrail.llm import queries
    from tests.compare import as_rows, oracle

    pages = [(0, "http://h0.com/de/x", "")]
    pages += [(i, f"http://h{i}.net/p", f'<a href="http://h{i - 1}.{"com" if i == 1 else "net"}/">y</a>') for i in range(1, 31)]
    pages += [(40, "http://good.org/", "<a href=//c1.net>1</a><a href='http://C2.net/x'>2</a>")]
    pages += [(41, "http://c1.net/", '<a href="http://c2.net">1</a>'), (42, "http://c2.net/", '<a href="//c1.net">1</a>')]
    pages += [(43, "no host", '<a href="//c1.net">1</a>'), (44, None, None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op9_url_filter(spark, str(tmp_path)).toArrow()
    want = oracle(str(tmp_path), queries.ORACLES["op9_url_filter"].replace("from pages", f"from '{tmp_path}/pages.parquet/*.parquet'"))
    assert as_rows(got) == as_rows(want)
    verdicts = dict(zip(got["page_id"].to_pylist(), got["verdict"].to_pylist()))
    assert [verdicts[i] for i in range(31)] == ["block" if 0.85**i >= 0.05 else "allow" for i in range(31)]


def test_numbers_are_no_letters(spark):
    docs = spark.createDataFrame(
        [(i, t, "en" if i < 9 else None) for i, t in enumerate(["some words", "\u00b2", "\u00bd", "\u2460", "\u2162", "12 _", "\u6f22", "x"])],
        "doc_id long, text string, lang string",
    )
    got = language.predict(docs, language.fit(docs, F.lit(True)))
    assert {r["doc_id"]: r["lang_pred"] for r in got.collect()} == {
        i: "und" if i in (1, 2, 3, 4, 5) else "en" for i in range(8)
    }


def test_links_without_quotes_and_links_inside_queries(spark):
    html = (
        "<a href=http://One.net/x>1</a><a class=y href=//two.net>2</a><a href='https://three.net#z'>3</a>"
        '<a href="/go?u=http://four.net/">4</a><a href=go//five.net>5</a><a href = " HTTP://six.net/a b">6</a>'
    )
    pages = spark.createDataFrame([("own.net", html)], "host string, html string")
    got = {r["dst"]: r["n"] for r in url_filter.host_links(pages).collect()}
    assert got == {"one.net": 1, "two.net": 1, "three.net": 1, "six.net": 1}


def test_long_item_leaves_short_ones_as_they_are(spark):
    pick = random.Random(6)
    common = [f"c{i}" for i in range(120)]
    say = lambda n: pick.choices(common, k=n)
    item = lambda n: (say(2 * n // 3), say(n - 2 * n // 3))
    parts = [item(n) for n in (6, 9, 12, 15, 30)]
    rows = [(i, " ".join(q) + ". " + " ".join(a)) for i, (q, a) in enumerate(parts)]
    long = " ".join(f"r{i % 700}" if i % 2 else w for i, w in enumerate(say(1900))) + ". " + " ".join(say(100))
    clean = [(i, " ".join(say(8000))) for i in range(4)]
    # The pairs of an item all over a text, and close by but in the wrong order.
    pairs = [*decontaminate.pairs_of(parts[4][0]), *decontaminate.pairs_of(parts[4][1])]
    spread = [w for pair in pairs for w in (*pair, *say(60))]
    pairs_back = [w for part in parts[4] for pair in zip(part[-2::-2], part[::-2]) for w in pair]
    planted = [say(777) + q + a + say(901) for q, a in parts]
    docs = [*clean, (4, " ".join(spread)), (5, " ".join(pairs_back))]
    docs += [(10 + i, " ".join(words)) for i, words in enumerate(planted)]
    docs += [(20, " ".join(say(500)) + " " + long + " " + " ".join(say(400)))]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = []
    for items in (rows, [*rows, (99, long)]):
        own = decontaminate.indexes(spark.createDataFrame(items, "item_id long, text string"))
        got = decontaminate.leaks(table, own).collect()
        found.append({(r["doc_id"], r["item_id"]): (r["begin"], r["end"]) for r in got})
    want = {(10 + i, i) for i in range(len(parts))}
    assert [found[0].keys(), found[1].keys()] == [want, want | {(20, 99)}]
    for i, (q, a) in enumerate(parts):
        n = len(q) + len(a)
        begin, end = found[0][10 + i, i]
        assert found[1][10 + i, i] == (begin, end)
        assert end - begin <= 2 * n and begin <= 777 + n // 2 <= end


def test_overlap_is_in_order():
    pick = random.Random(9)
    for _ in range(200):
        part, passage = (pick.choices("abcd", k=pick.randint(1, 12)) for _ in range(2))
        x = decontaminate.pairs_of(part)
        y = list(zip(passage, passage[1:])) if len(part) > 1 else [(w,) for w in passage]
        common = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, p in enumerate(x):
            for j, q in enumerate(y):
                common[i + 1][j + 1] = common[i][j] + 1 if p == q else max(common[i][j + 1], common[i + 1][j])
        assert decontaminate.overlap(part, passage) == common[-1][-1] / len(x)


def test_toxic_words_that_are_each_rare(spark):
    pick = random.Random(8)
    common, rare = [f"c{i}" for i in range(300)], [f"t{i}" for i in range(300)]

    def text(toxic, n=20):
        words = pick.choices(common, k=n) + pick.choices(rare, k=3 * toxic)
        pick.shuffle(words)
        return " ".join(words)

    docs = [(i, i % 2, text(i % 2)) for i in range(1800)]
    table = spark.createDataFrame(docs, "doc_id long, toxic int, text string")
    model = toxicity.fit(table, table, F.lit(True))
    held = [(toxic, model.judge(text(toxic))[0]) for toxic in (0, 1) for _ in range(150)]
    assert sum((score >= 0.5) == bool(toxic) for toxic, score in held) / len(held) >= 0.9
    known = {i for i in model.index.ids if i % 2}
    often = Counter(w for i in known for w in set(docs[i][2].split()))
    assert len(known) > 500 and max(often[w] for w in rare) < 20
    # Every indexed example finds itself, whatever its words.
    for i in model.index.ids[::20]:
        cosine, _ = model.judge(docs[i][2])[2][0]
        assert abs(cosine - 1.0) < 1e-9
    # Words that the index lacks count in the length.
    (short, _), (long, _) = (model.judge(docs[1][2] + more)[2][0] for more in ("", " unheard" * 30))
    assert long < 0.99 * short
    clean = text(0, 2000)
    assert model.judge(clean + " " + rare[0])[0] < 0.5
