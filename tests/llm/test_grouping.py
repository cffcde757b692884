"""Spelling variants, packing, and the prefix trie on awkward rows, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ringtrail.llm import packing, prefix_trie, spelling

DOCS = "doc_id long, text string, word string, number long, length long, n long, row long"


def edits(pick, word):
    at = pick.randrange(len(word))
    letter = pick.choice("abcé")
    return pick.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


@pytest.fixture(scope="module")
def spelled(spark):
    pick = random.Random(4)
    words = ["".join(pick.choice("abcé") for _ in range(pick.randint(6, 9))) for _ in range(60)]
    words += ["aaaaaa", "aaaaaaa", "ababababab", "babababab", "École", "ÉCOLES", "straße×÷"]
    words += [edits(pick, w) for w in words for _ in range(3)]
    rows = []
    for i in range(120):
        text = " ".join(pick.choice(words[: 1 + pick.randrange(len(words))]) for _ in range(60))
        rows.append((pick.choice([i, i, i, -i, None]), text))
    rows += [(7, " ".join(words * 40)), (8, None), (9, ""), (10, "1234 漢字 ?!"), rows[0], rows[0]]
    return spark.createDataFrame([(i, t, "w", 1, 2, 3, 4) for i, t in rows], DOCS).repartition(3).cache()


def brute_variants(rows):
    lower = str.maketrans(spelling.UPPER, spelling.LOWER)
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    words = {w: n for w, n in counts.items() if n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, found = {}, {w: [o for o in words if near(w, o)] for w in words}
    for w, others in found.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best and words[best] >= 5 * words[w]:
            form[w] = best
    rows = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, n, len(found[w]), form.get(w), words.get(form.get(w)), root))
    return rows


@pytest.mark.parametrize("hot_entries", [2, 20_000])
def test_spelling_variants(spelled, hot_entries):
    got = spelling.variants(spelled, hot_entries=hot_entries)
    want = brute_variants([(r["doc_id"], r["text"]) for r in spelled.collect()])
    assert {tuple(r) for r in got.select("word", "n", "n_near", "form", "form_n", "root").collect()} == want
    assert got.count() == len(want) > 100
    assert any(w[3] and w[5] != w[3] for w in want) or any(w[3] for w in want)


def test_roots_are_at_the_end_of_a_chain(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)], "word string, form string")
    assert {tuple(r) for r in spelling.roots(forms).collect()} == {(f"w{i}", "w9") for i in range(9)}


def test_a_pivot_is_in_the_other_words_prefix():
    pick = random.Random(2)
    weight = lambda gram: zlib.crc32(gram.encode()) % 5
    for _ in range(5000):
        one = "".join(pick.choice("abc") for _ in range(pick.randint(5, 10)))
        other = edits(pick, one)
        if len(other) < 5 or one == other:
            continue
        ends = []
        for word in (one, other):
            prefix, pivots = spelling.prefix_and_pivots(word, weight)
            assert pivots[0] + 2 <= pivots[1]
            ends.append((prefix[-1][:2], prefix, pivots, word))
        (_, prefix, pivots, word), (_, index, _, longer) = sorted(ends, key=lambda e: e[0])
        moves = {(len(longer) - len(word), p[2] - at) for at in pivots for p in index if p[1] == word[at : at + 2]}
        assert moves & set(spelling.MOVES)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def whole(tokenizer):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(tokenizer)
    library.encode_special_tokens = True
    return lambda text: library.encode(text, add_special_tokens=False).ids


def test_chunks_give_the_ids_of_whole_texts(tokenizer, whole):
    encoder, pick = packing.Encoder(tokenizer), random.Random(6)
    letters = "abzABZ éÈÿß×÷'’\"!?.,-–0129²½ⅣΣσςİıñ漢😀̀‍\t\r\n\x0b  "
    parts = ["'s", "'T", "'re", " ", "hello", "École", "<|endoftext|>", "\n", "don't", "'"]
    for _ in range(3000):
        text = "".join(pick.choice([*parts, *letters]) for _ in range(pick.randrange(14)))
        assert list(np.frombuffer(encoder.encode(text), "<u4")) == whole(text), repr(text)


def test_words_are_forgotten_by_halves(tokenizer, whole, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encoder = packing.Encoder(tokenizer)
    text = "one two three four five one two six seven one " * 3
    assert list(np.frombuffer(encoder.encode(text), "<u4")) == whole(text)
    assert max(len(encoder._words), len(encoder._chunks)) <= 3


def test_texts_encoded_together_give_the_ids_of_each(tokenizer, whole, monkeypatch):
    encoder, pick = packing.Encoder(tokenizer), random.Random(8)
    parts = ["hello", "École", "don't", "ÿß", "×", "a1b22", "...", "'", "'S", "A", " ", " ", "\n", "漢", "\x0b"]
    texts = ["", " ", "\n", "plain", *("".join(pick.choices(parts, k=pick.randrange(20))) for _ in range(2000))]
    want = [whole(text) for text in texts]
    got = [list(np.frombuffer(ids, "<u4")) for ids in encoder.encode_all(texts)]
    assert got == want
    assert [list(encoder.encode_all(some)) for some in ([], [""], ["漢"])] == [[], [b""], [encoder.encode("漢")]]

    # A chunk is encoded once, however often it occurs in the texts.
    seen = []
    encoder = packing.Encoder(tokenizer)
    monkeypatch.setattr(encoder, "_words", type("Counted", (), {"__getitem__": lambda _, w: seen.append(w) or b"...."})())
    assert list(encoder.encode_all(["one two one", "two one"])) == [b"...." * 3, b"...." * 2]
    assert sorted(seen) == ["one", "two"]


def test_texts_are_taken_together_up_to_a_size(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "TOGETHER", 10)
    texts = ["abcd", "", "é" * 30, "x", "y" * 9, "z"]
    batches = [pa.RecordBatch.from_arrays([pa.array([i, None]), pa.array(texts[i : i + 2])], ["d", "t"]) for i in (0, 2, 4)]
    got = list(packing._together(batches))
    assert got == [([0, None, 2], texts[:3]), ([None, 4], texts[3:5]), ([None], texts[5:])]


@pytest.mark.parametrize("block", [16, 2048])
def test_packing(spark, spelled, tokenizer, whole, block):
    rows = [(r["doc_id"], (r["text"] or "")[: 40 * (n % 7)]) for n, r in enumerate(spelled.collect())]
    rows += [(500, "word " * 700), (501, "x" * 300), (None, "word " * 127), (None, None), (7, "word " * 63)]
    docs = spark.createDataFrame([(i, t, "w", 1, 2, 3, 4) for i, t in rows], DOCS)
    packed = packing.pack(docs, tokenizer, capacity=128, block=block).cache()
    got = packed.collect()
    want = Counter()
    for doc_id, text in rows:
        ids = [*whole(text or ""), 0]
        for piece, start in enumerate(range(0, len(ids), 128)):
            want[doc_id, piece, start, tuple(ids[start : start + 128])] += 1
    ids = lambda r: tuple(np.frombuffer(r["ids"], "<u4").tolist())
    assert Counter((r["doc_id"], r["piece"], r["start"], ids(r)) for r in got) == want
    assert all(r["length"] == len(ids(r)) and r["ids_crc32"] == zlib.crc32(r["ids"]) for r in got)
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 128
    lengths = [r["length"] for r in got]
    greedy = len(packing.best_fit([], list(range(len(lengths))), lengths, 128))
    # Blocks of 16 documents leave more room unused than usual ones.
    assert -(-sum(lengths) // 128) <= len(by_sequence) <= (greedy if block == 2048 else 1.1 * greedy)
    joined = packing.sequences(packed).collect()
    assert {r["sequence_id"]: len(r["ids"]) for r in joined} == {
        s: 4 * sum(n for _, n in m) for s, m in by_sequence.items()
    }


def test_children_keep_every_document_once():
    pick = random.Random(8)
    lengths = [pick.randint(1, 100) for _ in range(200)]
    population = packing.founded(lengths, 100, 4, pick)
    before = packing.cost(population[0])
    after = packing.evolved(population, lengths, 100, 60, pick)
    for packed in after:
        assert sorted(i for _, members in packed for i in members) == list(range(200))
        assert all(fill == sum(lengths[i] for i in members) <= 100 for fill, members in packed)
    assert packing.cost(after[0]) <= before
    # Pairs that fill a sequence exactly, which the longest first with best fit finds too.
    assert len(packing.best_fit([], list(range(6)), [60, 40, 70, 30, 90, 10], 100)) == 3


TURNS = "conv_id long, turn long, role string, text string, depth long, owner long, top long"


def _conversations():
    pick = random.Random(3)
    say = lambda n: "".join(pick.choice("ab é漢") for _ in range(n))
    rows = []
    for conv in [*range(-120, 320, 3), 0, 100, 200, -100]:
        for turn in range(pick.choice([0, 1, 2, 5, 9])):
            rows.append((conv, turn, pick.choice(["user", "assistant"]), pick.choice(["hi", "yes", say(5)])))
    rows += [(600, turn, "user", "same") for turn in range(90)]
    rows += [(601, turn, "user", "same") for turn in range(70)]
    rows += [(c, t, "user", ["first", f"{c % 2}"][t]) for c in range(1000, 1040) for t in range(2)]
    rows += [(700, None, "user", "early"), (700, 1, None, "a"), (700, 1, "user", None), (700, 1, "user", "b")]
    rows += [(None, 1, "user", "nobody's"), (701, 2, "user", "twice"), (701, 2, "user", "twice"), (702, None, None, None)]
    return rows


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, role, digest, text))
    rebuilt = {}
    for conv in turns:
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        one = sorted(turns.get(base, []))[:h] + sorted(turns[conv])[h:]
        rebuilt[conv] = [(role, text) for _, _, role, _, text in one]
    members = defaultdict(list)
    for conv, path in rebuilt.items():
        for depth in range(len(path) + 1):
            members[tuple(path[:depth])].append(conv)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += (len(convs) - 1) * (len(node[-1][1]) if node else 0)
    found = set()
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        found.add(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                children[node],
                leaves[node],
                saved[node],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return found


@pytest.mark.parametrize("at_once", [1, 20, 50_000])
def test_prefix_trie(spark, at_once, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    rows = _conversations()
    random.Random(2).shuffle(rows)
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURNS).repartition(3)
    got = prefix_trie.branched_trie(table, at_once).collect()
    want = brute_trie(rows)
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want


def test_centroids_of_random_forests():
    pick = random.Random(9)
    for _ in range(200):
        size = pick.randint(1, 60)
        parents = [pick.randint(max(-1, n - pick.choice([1, 3, 60])), n - 1) if n else -1 for n in range(size)]
        weights = [pick.randint(1, 9) for _ in range(size)]
        values = [(pick.randint(0, 5), pick.randint(-3, 3)) for _ in range(size)]
        below, want = list(weights), [list(v) for v in values]
        for n in reversed(range(size)):
            if parents[n] >= 0:
                below[parents[n]] += below[n]
                want[parents[n]] = [a + b for a, b in zip(want[parents[n]], want[n])]
        assert prefix_trie.centroid_totals(parents, weights, below, values) == want


def test_empty_tables(spark, tokenizer):
    docs = spark.createDataFrame([], DOCS)
    assert spelling.variants(docs).count() == 0
    assert packing.pack(docs, tokenizer).count() == 0
    assert prefix_trie.branched_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.branched_trie(spark.createDataFrame([(None, 1, "a", "b", 1, 2, 3)], TURNS)).count() == 0
