"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import pathlib
import random
import time
import urllib.parse
from collections import Counter
from math import log, log10

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidecast.llm import (
    audit,
    common,
    crf,
    decontam,
    language,
    minhash,
    negatives,
    packing,
    quality,
    sharding,
    simhash,
    substring,
    suffixlm,
    tensored,
    tokenbin,
    urls,
)

LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(60_000))
PROSE = "the small dog runs over a green hill and then it sleeps under the old tree near our river. "
ROWS = [
    (1, PROSE * 3, "en"), (2, None, None), (3, "", "en"), (4, PROSE * 3, "en"), (4, PROSE * 3, "en"), (None, PROSE, "en"),
    (None, None, None), (7, LONG, None), (8, " \n\t ", "de"), (9, "123 ### \n", "en"), (10, "ein Hund läuft über den grünen Hügel und schläft", "de"),
    (4, "another text with the same key as the rows before it, which is fine", "en"),
]
SCHEMA = "doc_id long, text string, lang string"
#: Names that the operators use for their own columns.
CLASHES = ["_part", "_key", "_text", "fp", "rank", "digest", "shard", "size", "n", "key", "row", "_row", "removed", "spans", "item_id", "sequence_id", "_leak", "_doc", "_fp", "_wanted", "_kept", "_kept_fp", "_row2", "id", "label", "part", "failed", "node", "met", "root", "filter", "before", "digest"]
WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def wide(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHES if c not in df.columns})


@pytest.fixture(scope="module")
def docs(spark):
    return wide(spark.createDataFrame(ROWS, SCHEMA)).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return wide(spark.createDataFrame([], SCHEMA))


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "runs over a green hill and then it sleeps under the old"), (2, None), (3, "the old tree"), (4, "")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("shingle", F.lit("clash"))


def operators(spark, items):
    tree = lambda d: suffixlm.score(d, *suffixlm.train(d, F.lit(True)), F.lit(False))
    labels = spark.createDataFrame([(1, 1), (9, 0), (9, None), (None, 1)], "doc_id long, quality int")

    def token_file(d):
        path = common.scratch_dir(spark, "edge-tokens")
        tokenbin.write(d, path, BYTES, 2)
        return tokenbin.read(spark, path)

    return {
        "sharding": lambda d: sharding.assign(d, 4, 5),
        "packing": lambda d: packing.pack(packing.pieces(d, WORDS, 64, 0), 64, ["doc_id", "piece"]),
        "substring": substring.dedup,
        "decontamination": lambda d: decontam.clean(d, items),
        "suffix tree": tree,
        "quality": lambda d: quality.judge(d, quality.train(d, labels)),
        "simhash": simhash.near_duplicates,
        "keep one": simhash.keep_one,
        "keep one near": minhash.keep_one,
        "tensored": tensored.near_duplicates,
        "audit": lambda d: audit.interactions(d, spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")),
        "token file": token_file,
        "language": lambda d: language.identify(d, language.train(d, F.lit(True))),
    }


NAMES = ["sharding", "packing", "substring", "decontamination", "suffix tree", "quality", "simhash", "keep one", "keep one near", "tensored", "audit", "token file", "language"]


@pytest.mark.parametrize("name", NAMES)
def test_an_empty_table_gives_an_empty_result(name, spark, none, items):
    assert operators(spark, items)[name](none).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_keep_their_place(name, spark, docs, items):
    got = operators(spark, items)[name](docs).collect()
    if name in ("sharding", "substring", "suffix tree", "quality", "simhash", "tensored", "token file", "language"):
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)


def test_sharding_counts_null_and_repeated_rows(docs):
    got = sharding.assign(docs, 3).collect()
    assert {r["size"] for r in got if r["doc_id"] == 2} == {8} and {r["text_crc32"] for r in got if r["doc_id"] == 3} == {0}
    assert len({r["shard"] for r in got if r["doc_id"] == 4}) == 1 == len({r["shard"] for r in got if r["doc_id"] is None})
    with pytest.raises(ValueError):
        sharding.shard_of("doc_id", {0: 0.0})


@pytest.mark.parametrize("seed", range(5))
def test_packing_rounds_place_each_rank_once(seed):
    rng = random.Random(seed)
    runs = {rng.randint(1, 50): rng.randint(1, 400) for _ in range(rng.randint(0, 30))}
    blocks, used = packing.plan(runs, 50), {}
    starts = {}
    for length, first, *_ in blocks:
        starts.setdefault(length, []).append(first)
    for length, first, each, sequence, offset in blocks:
        end = min([x for x in starts[length] if x > first], default=runs[length])
        for rank in range(first, end):
            place = (sequence + (rank - first) // each, offset + (rank - first) % each * length)
            used.setdefault(place[0], []).append((place[1], length))
    assert sum(map(len, used.values())) == sum(runs.values())
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 50
    total = sum(k * n for k, n in runs.items())
    assert len(used) <= 11 / 9 * -(-total // 50) + 1


def test_packing_rejects_lengths_beyond_the_capacity(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 70)], "doc_id long, length long"), 64, ["doc_id"])


def test_packed_sequences_hold_the_ids(docs):
    packed = packing.pack(packing.pieces(docs, WORDS, 64, 0, with_ids=True), 64, ["doc_id", "piece"])
    rows, joined = packed.collect(), {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in rows:
        own = joined[r["sequence_id"]]["ids"][4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        assert bytes(own) == bytes(r["ids"])


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_cached_units_equal_one_call(path):
    from tokenizers import Tokenizer

    plain, rng = Tokenizer.from_file(path), random.Random(5)
    ids = common.WordIds(path, limit=50)
    alphabet = "ab AZ\n\t'.,!?_0s é한\u0301\u00a0 1९<|>İΣς\x1c\x85क़%"
    odd = ["", " ", "\n", "a  b", "don't <|endoftext|> we'll", "\n\n a \n b", "x\0y", PROSE, "a <|EndOfText|> b", "<|startoftext|>", "a<|endoftext|>", "the Öl ığ ÀÉ über"]
    for text in odd + ["".join(rng.choices(alphabet, k=rng.randint(0, 50))) for _ in range(800)]:
        assert ids.encode(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 65535, 65536, 2**32 - 1], list(range(0, 70_000, 7)), [3] * 2000])
def test_codes_are_addressable(ids):
    opened = tokenbin.Segment(tokenbin.encode(np.array(ids, "<u4")))
    assert len(opened) == len(ids) and opened[:].tolist() == ids
    for at in {0, 1, len(ids) // 2, len(ids) - 1} & set(range(len(ids))):
        assert opened[at] == ids[at] and opened[at - len(ids)] == ids[at] and opened[at : at + 700].tolist() == ids[at : at + 700]
    with pytest.raises(IndexError):
        opened[len(ids)]
    with pytest.raises(ValueError):
        tokenbin.Segment(b"none of ours")


def test_chunks_resist_insertions_and_passages_go():
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n)) + " "
    caught = 0
    for _ in range(100):
        passage = prose(55)
        first, second = prose(70) + passage + prose(40), prose(31) + passage + prose(90)
        _, ends, digests = substring.chunks(second)
        spans = substring.removed_spans(ends, digests, set(substring.chunks(first)[2]), 80)
        caught += sum(b - a for a, b in spans) > len(passage) / 2
        assert all(31 <= second[:a].count(" ") and b <= len(second) for a, b in spans)
    assert caught >= 98
    text = prose(3000)
    moved = substring.chunks("new " + text[:9000] + "inserted " + text[9000:])[2]
    assert len(set(substring.chunks(text)[2]) - set(moved)) <= 6
    assert substring.cuts(b"x" * 3_000_000)[-1] == 3_000_000
    whole = LONG.encode() * 4
    assert np.array_equal(substring.cuts(whole), substring.cuts(whole + b"tail")[: len(substring.cuts(whole)) - 1].tolist() + [len(whole)])


def test_substring_keeps_one_copy_and_clean_documents(spark):
    rows = [(k, f"own{k} " * 5 + PROSE * 2 + f"rest{k}") for k in range(6)] + [(9, "nothing in common here at all")]
    got = {r["doc_id"]: r["text"] for r in substring.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[9] == rows[-1][1]
    assert sum("sleeps under the old tree" in t for t in got.values()) == 1


def test_decontamination_finds_short_items_in_long_texts(spark, items):
    parts = LONG.split(" ")
    leak = "Runs over a green hill, and then it sleeps under the OLD"
    rows = [(1, " ".join(parts[:30_000]) + f" {leak} " + " ".join(parts[30_000:])), (2, LONG), (3, "the old tree"), (None, leak), (5, None)]
    got = decontam.search(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert [(r["doc_id"], r["item_id"], r["containment"]) for r in got] == [(1, 1, 1.0)]
    part = spark.createDataFrame([(1, "a b c d e f g h i j k l m n X"), (2, "a b c d e f g h i j k l X")], "doc_id long, text string")
    item = spark.createDataFrame([(7, "a b c d e f g h i j k l m n")], "item_id long, text string")
    assert [(r["doc_id"], r["n_shared"]) for r in decontam.search(part, item, threshold=0.8).orderBy("doc_id").collect()] == [(1, 10), (2, 8)]
    assert [r["doc_id"] for r in decontam.search(part, item, threshold=0.9).collect()] == [1]


def test_every_pair_within_two_bits_shares_a_mask():
    found = [m & (2**64 - 1) for m in simhash.masks()]
    assert len(found) == 7
    for a in range(64):
        for b in range(64):
            assert any(not m & (1 << a | 1 << b) for m in found)


@pytest.mark.parametrize("seed", range(3))
def test_links_connect_what_all_pairs_connect(seed, spark):
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(150):
        prints.append(rng.choice(prints) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    root = {p: p for p in prints}
    for a in prints:
        for b in prints:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    got = {r["a"]: r["b"] for r in common.components(edges).collect()}
    assert {p: got.get(p, p) for p in prints} == root


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 2000 + i) for i in range(200)] + [(5, 5)]
    got = {r["a"]: r["b"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {2000 + i: 1000 for i in range(200)}


def test_near_copies_are_found_by_simhash_without_a_band(spark):
    rng = random.Random(4)
    words = [rng.choice("abcdefghij") + str(rng.randrange(90)) for _ in range(400)]
    whole, other = " ".join(words), " ".join(rng.sample(words, 400))
    of = lambda t: simhash.majority(minhash.shingles(t))
    near = next(t for t in (f"{whole} z{k}" for k in range(200)) if 0 < ((of(t) ^ of(whole)) & (2**64 - 1)).bit_count() <= 2)
    same = next(t for t in (f"{whole} y{k}" for k in range(2000)) if of(t) == of(whole))
    rows = [(1, whole, "en"), (2, near, "en"), (3, other, "en"), (4, same, "en"), (5, None, "en")]
    docs = spark.createDataFrame(rows, SCHEMA)
    prints = minhash.prints(docs).withColumn("bands", F.array().cast("array<long>"))
    root = {r["fp"]: r["root"] for r in minhash.classes(docs, prints).collect()}
    of_doc = {k: root[minhash.print_of(minhash.shingles(t))] for k, t, _ in rows}
    assert of_doc[1] == of_doc[2] == of_doc[4] and len({of_doc[k] for k in (1, 3, 5)}) == 3


@pytest.mark.parametrize("keep_one", [simhash.keep_one, minhash.keep_one])
def test_one_of_each_group_stays(docs, keep_one):
    got = keep_one(docs)
    assert got.columns == docs.columns
    texts = [r["text"] for r in got.collect()]
    assert texts.count(PROSE * 3) == 1 and sum(not (t or "").strip() for t in texts) == 1
    assert sorted(t for t in texts if t and t.strip()) == sorted({r[1] for r in ROWS if r[1] and r[1].strip()} - set())


def test_forward_backward_and_viterbi_match_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    lengths, moves = np.array([3, 0, 1, 4]), rng.normal(size=(3, 3))
    scores = rng.normal(size=(8, 3))
    shares, pairs = crf.marginals(scores, lengths, moves)
    labels, at, expected = crf.viterbi(scores, lengths, moves), 0, np.zeros((3, 3))
    for n in lengths:
        own = scores[at : at + n]
        paths = list(product(range(3), repeat=int(n)))
        value = np.array([sum(own[i, y] for i, y in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:])) for p in paths])
        weight = np.exp(value) / np.exp(value).sum()
        for i in range(n):
            assert np.allclose(shares[at + i], [sum(w for w, p in zip(weight, paths) if p[i] == y) for y in range(3)])
        for w, p in zip(weight, paths):
            for a, b in zip(p, p[1:]):
                expected[a, b] += w
        assert tuple(labels[at : at + n]) == paths[int(value.argmax())]
        at += n
    assert np.allclose(pairs, expected)


def test_languages_of_switched_and_letterless_texts(spark):
    english, german = "the dog sleeps under the tree and runs over the hill", "der Hund schläft unter dem Baum und läuft über den Hügel"
    rows = [(k, (english if k % 2 else german), "en" if k % 2 else "de") for k in range(40)]
    model = language.train(spark.createDataFrame(rows, SCHEMA), F.lit(True))
    odd = [(1, f"{english} {german} {german}", None), (2, "12 34 ##", None), (3, None, None)]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(odd, SCHEMA), model).collect()}
    assert got[1]["lang_pred"] == "de" and [r["lang"] for r in got[1]["runs"]] == ["en", "de"]
    assert [(got[k]["lang_pred"], got[k]["score"]) for k in (2, 3)] == [("und", 0.0)] * 2
    blind = language.identify(spark.createDataFrame(odd, SCHEMA), None).collect()
    assert {r["lang_pred"] for r in blind} == {"und"}


def test_tree_probabilities_sum_to_one(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["a b", "a c", "d e f"]) for _ in range(200)), "en") for k in range(5)]
    tree, counts = suffixlm.train(spark.createDataFrame(rows, SCHEMA), F.lit(True))
    words = np.arange(len(tree.words))
    rare = sum(r["n"] + 1 for r in counts.collect() if r["key"] not in set(tree.words.tolist()))
    for two in [-1, *words]:
        for one in words:
            some = tree.probabilities(np.full(len(words), two), np.full(len(words), one), words).sum()
            left = tree.probabilities(np.array([two]), np.array([one]), np.array([-1]))[0]
            assert some + left * (rare + 1) / tree.mass == pytest.approx(1)


def brute_force_tree(texts):
    """log10 probability of each text by dictionaries: contexts of up to two words, all that occurs three times counts."""
    seen, sizes = [Counter(), Counter(), Counter()], [Counter(), Counter(), Counter()]
    streams = [[None, *t.split(), None] for t in texts]
    for own in streams:
        for i in range(1, len(own)):
            for k in range(min(i, 2) + 1):
                seen[k][tuple(own[i - k : i + 1])] += 1
                sizes[k][tuple(own[i - k : i])] += 1
    mass = seen[0].total() + len(seen[0]) + 1
    states = {}

    def p(context, word):
        if not context:
            return (seen[0][(word,)] + 1) / mass
        below = p(context[1:], word)
        if context not in states:
            return below
        n = seen[len(context)][(*context, word)]
        return (n - 0.5) / sizes[len(context)][context] * (n >= 3) + states[context] * below

    for k in (1, 2):
        found = {}
        for context, total in sizes[k].items():
            nexts = {g[-1]: n for g, n in seen[k].items() if g[:-1] == context and n >= 3}
            parent = {w: p(context[1:], w) for w in nexts}
            left = max(1 - sum(nexts.values()) / total, 1e-12)
            apart = sum(n / total * log(n / total / parent[w]) for w, n in nexts.items()) + left * log(left / max(1 - sum(parent.values()), 1e-12))
            if nexts and apart >= suffixlm.DIVERGENCE:
                found[context] = 1 - sum((n - 0.5) / total for n in nexts.values())
        states |= found
    return [sum(log10(p(tuple(own[max(0, i - 2) : i]), own[i])) for i in range(1, len(own))) for own in streams]


@pytest.mark.parametrize("share", [1.0, 0.01, 1e-9])
def test_tree_loses_nothing_that_is_rare_in_a_large_corpus(spark, monkeypatch, share):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a b", "a c d", f"x{rng.randrange(40)} y", "m n o"]) for _ in range(40)) for _ in range(30)]
    rows = [(k, t, "en") for k, t in enumerate(texts)]
    for name in ("WORD", "NEXT"):
        monkeypatch.setattr(suffixlm, name, share)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r["score"] for r in suffixlm.score(docs, *suffixlm.train(docs, F.lit(True)), F.lit(False)).collect()}
    assert [got[k] for k in range(len(texts))] == pytest.approx(brute_force_tree(texts), abs=1e-6)


def test_hashes_of_sequences_are_those_of_spark(spark):
    pairs = [(0, 0), (-1, 5), (1 << 62, -(1 << 63)), (123456789, -987654321)]
    own = suffixlm.gram_of(*np.array(pairs, "int64").T)
    assert own.tolist() == [r[0] for r in spark.createDataFrame(pairs, "a long, b long").coalesce(1).select(F.xxhash64("a", "b")).collect()]


def test_urls_of_every_shape(spark):
    rows = [(1, "HTTP://A.Org/x?q=1#f"), (2, None), (3, "no scheme"), (4, "http://spam.com"), (4, "http://spam.com"), (5, "x://b.org:80/"), (6, "a://b://c/d"), (7, ""), (8, "http://é.de/" + "a1" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: r for r in urls.judge(pages, ["org/"], ["com/", "de/"]).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("a.org", "/x", "org/", "allow")
    assert [(got[k]["host"], got[k]["path"]) for k in (2, 3, 4, 6, 7)] == [("", ""), ("", ""), ("spam.com", ""), ("b:", "//c/d"), ("", "")]
    assert got[4]["rule"] is None and got[8]["verdict"] == "block"
    assert urls.judge(pages.limit(0), ["org/"], []).collect() == []
    assert {r["verdict"] for r in urls.judge(pages, [], []).collect()} == {"allow"}


def test_trees_judge_hosts_that_they_never_saw(spark):
    rng = random.Random(21)
    word = lambda n: "".join(rng.choices("etaoinshrdlu", k=n))
    rows = []
    for host in range(240):
        bad = host % 2
        name = f"{word(4)}-{word(3)}{rng.randint(100, 9999)}.{rng.choice(['top', 'biz', 'com'])}" if bad else f"{word(8)}.{rng.choice(['com', 'org', 'edu'])}"
        for _ in range(6):
            tail = f"/{word(3)}{rng.randint(0, 99999)}?id={rng.randint(0, 9**9)}&ref={word(3)}&s={rng.randint(0, 9)}" if bad else f"/{word(6)}/{word(7)}"
            rows.append((len(rows), f"http://{name}{tail}", None if host >= 160 else bad, bad))
    # One URL that fills most of the table teaches no more than any other.
    rows += [(len(rows) + k, "http://copied.com/page", 0, 0) for k in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, label int, truth int").repartition(4)
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages, [], [], sample=600, label="label").collect()}
    held = [(got[k], bad) for k, _, label, bad in rows if label is None]
    assert len(held) == 480 and sum((v == "block") == bool(bad) for v, bad in held) >= 0.95 * len(held)


def test_phrases_of_different_documents_are_no_repeated_passage(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9)))
    phrases = [" ".join(word() for _ in range(9)) + " " for _ in range(400)]
    rows = [(k, "".join(rng.sample(phrases, 12))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert any(substring.removed_spans(ends, own, {d for j, t in rows if j != k for d in substring.chunks(t)[2]}, 80)
               for k, t in rows[:3] for _, ends, own in [substring.chunks(t)])
    got = substring.dedup(docs).collect()
    whole = {r[0]: r[1].encode() for r in rows}
    joined = b"\0".join(whole.values())
    for r in got:
        own = whole[r["doc_id"]]
        for start, end in r["removed"]:
            pieces = [own[a : a + 80] for a in range(start, end - 79)]
            held = [joined.count(p) > 1 for p in pieces]
            assert all(any(held[max(0, x - 79 - start) : x - start + 1]) for x in range(start, end))


@pytest.mark.parametrize("letters", ["的一是不了人我在有他这中大来上国个到说们", "กขคงจฉชซญดตถทนบปผฝพฟ", "あいうえおかきくけこさしすせそたちつてと", "abcdefghijklmnopqrst"])
def test_passages_without_spaces_go(spark, letters):
    rng = random.Random(6)
    prose = lambda n: "".join(rng.choices(letters, k=n))
    size = 1200 // len(letters[0].encode())
    passages = [prose(size) for _ in range(30)]
    rows = [(2 * k + j, prose(2 * size) + p + prose(size)) for k, p in enumerate(passages) for j in range(2)]
    rows += [(99, prose(3 * size))]
    got = {r["doc_id"]: r for r in substring.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    cut = [sum(b - a for j in range(2) for a, b in got[2 * k + j]["removed"]) for k in range(30)]
    assert all(800 <= n <= 1200 for n in cut), cut
    assert got[99]["removed"] == []
    assert all("�" not in r["text"] for r in got.values())


def test_a_document_that_mixes_languages_evenly_is_certain(spark):
    parts = {"en": "the dog sleeps under the tree and runs over the hill", "de": "der Hund schläft unter dem Baum und läuft über den Hügel",
             "fr": "le chien dort sous cet arbre puis court vers une colline"}
    rows = [(k, text, lang) for k in range(20) for lang, text in parts.items()]
    model = language.train(spark.createDataFrame(rows, SCHEMA), F.lit(True))
    mixed = spark.createDataFrame([(1, " ".join(parts.values()), None)], SCHEMA)
    (got,) = language.identify(mixed, model).collect()
    assert got["score"] < 0.45 and got["certainty"] > 0.8 and {r["lang"] for r in got["runs"]} == set(parts)


def test_tensored_classes_of_odd_rows(docs):
    got = {}
    for r in tensored.near_duplicates(docs).collect():
        got.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"], r["kept"]))
    assert {n for n, _, _ in got[1]} == {19} and got[1] == {(19, 1, True)}
    assert (19, 1, False) in got[4] and len(got[4]) == 2
    assert got[2] == {(0, 2, True)} and got[3] == {(0, 3, True)} and got[8] == {(0, 8, True)} and got[9] == {(1, 9, True)}
    assert {n for n, _, _ in got[None]} == {0, 15} or (0, None, True) in got[None]


def test_hashes_of_either_collection_agree_as_often_as_they_should():
    rng = np.random.default_rng(8)
    for _ in range(3):
        whole = rng.integers(0, 1 << 63, 400, "uint64")
        a, b = np.unique(whole[:370]), np.unique(whole[30:])
        hits = np.mean([np.mean(tensored.hashes(a ^ x) == tensored.hashes(b ^ x)) for x in rng.integers(0, 1 << 63, 60, "uint64")])
        assert abs(hits - (340 / 400) ** tensored.HALF) < 0.06
    assert (1 - 0.85**tensored.HALF) ** tensored.COLLECTION < 3e-7


def test_unlike_texts_with_one_template_are_compared_in_linear_pairs(spark, monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(3, 9)))
    template = " ".join(word() for _ in range(120))
    rows = [(k, template + " " + " ".join(word() for _ in range(50))) for k in range(400)]
    pairs, measured = [], tensored._measured

    def counted(found, sets, least):
        pairs.append(found.count())
        return measured(found, sets, least)

    monkeypatch.setattr(tensored, "_measured", counted)
    got = tensored.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["kept"] for r in got) and len(got) == 400 and sum(pairs) < 2 * 400


def test_nodes_far_from_a_pivot_get_another(spark, monkeypatch):
    rng = random.Random(15)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(4, 9)))
    bases = [[word() for _ in range(120)] for _ in range(5)]
    whole = bases[0]
    rows = []
    for k in range(200):
        own = list(bases[k % 5]) if k % 10 < 5 else whole[: 24 * (k % 5)] + bases[k % 5][24 * (k % 5) :]
        for at in rng.sample(range(120), k % 4):
            own[at] = word()
        rows.append((k, " ".join(own)))
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, t in rows for w in [t.split()]}
    root = {k: k for k in sets}
    for a in sets:
        for b in range(a):
            if root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    monkeypatch.setattr(tensored, "_clusters", lambda met: tensored.staged(
        met.select("node", F.lit(met.agg(F.min("node")).first()[0] or 0).alias("pivot")).distinct(), "clusters"))
    for rounds in (1, 2, 4):
        monkeypatch.setattr(tensored, "ROUNDS", rounds)
        got = tensored.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == root


def test_stored_tables_leave_no_shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {f for d in folders for f in pathlib.Path(str(d)).rglob("shuffle_*.data")}
    was = files()
    found = common.staged(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "seven")
    until = time.monotonic() + 20
    while files() - was and time.monotonic() < until:
        time.sleep(0.1)
    assert not files() - was and found.count() == 7


def test_the_tree_keeps_only_the_tables_that_scoring_reads(spark, monkeypatch):
    labels, stored = {}, suffixlm.staged

    def kept(df, label):
        found = stored(df, label)
        labels.setdefault(label, []).extend(pathlib.Path(urllib.parse.urlparse(f).path) for f in found.inputFiles())
        return found

    monkeypatch.setattr(suffixlm, "staged", kept)
    rows = [(k, "one two three four five six") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tree, words = suffixlm.train(docs, F.lit(True))
    left = {label for label, files in labels.items() if any(f.exists() for f in files)}
    assert {"words", "sequences"} <= left and not left & {"counts", "joined", "level", "states"}
    assert suffixlm.score(docs, tree, words, F.lit(False)).count() == 20


def test_copies_of_one_another_far_from_the_pivot_cost_linear_pairs(spark, monkeypatch):
    rng = random.Random(16)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(4, 9)))
    base = [word() for _ in range(160)]
    other = [word() for _ in range(160)]
    rows = [(0, " ".join(other))]
    for k in range(1, 201):
        own = list(base if k < 200 else other)
        own[rng.randrange(160)] = word()
        rows.append((k, " ".join(own)))
    monkeypatch.setattr(tensored, "_clusters", lambda met: tensored.staged(
        met.select("node", F.lit(0).cast("long").alias("pivot")).distinct(), "clusters"))
    monkeypatch.setattr(tensored, "ROUNDS", 1)
    pairs, measured = [], tensored._measured

    def counted(found, sets, least):
        pairs.append(found.count())
        return measured(found, sets, least)

    monkeypatch.setattr(tensored, "_measured", counted)
    got = tensored.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {r["component_id"] for r in got} == {0, 1} and 200 < sum(pairs) < 4 * 200


def test_near_copies_that_miss_the_threshold_cost_no_pairs(spark, monkeypatch):
    rng = random.Random(14)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(4, 9)))
    base = [word() for _ in range(150)]
    rows = []
    for k in range(300):
        own = list(base)
        for at in rng.sample(range(150), 3 + k % 3):
            own[at] = word()
        rows.append((k, " ".join(own)))
    pairs, confirmed = [], tensored._confirmed

    def counted(found, sets, least):
        pairs.append(found.count())
        return confirmed(found, sets, least)

    monkeypatch.setattr(tensored, "_confirmed", counted)
    got = tensored.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r["component_id"] for r in got}) > 250 and pairs[-1] < 2000 < 300 * 299 / 2


def test_near_copies_link_as_all_pairs_do(spark):
    rng = random.Random(10)
    plain = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(3000)]
    rows = []
    for _ in range(6):
        base = rng.choices(plain, k=rng.randint(80, 300))
        for _ in range(40):
            own = list(base)
            for at in rng.sample(range(len(own)), rng.randint(0, len(base) // 30)):
                own[at] = rng.choice(plain)
            rows.append((len(rows), " ".join(own)))
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, t in rows for w in [t.split()]}
    root = {k: k for k in sets}
    for a in sets:
        for b in range(a):
            if root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    got = tensored.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {k: (len(sets[k]), root[k]) for k in sets}
    assert 6 <= len(set(root.values())) < 200


@pytest.mark.parametrize("size", [1, 3, 64, 100])
def test_intervals_hold_the_inner_products(size):
    rng = np.random.default_rng(size)
    rows = np.rint(rng.normal(size=(200, size)) * rng.choice([1, 30, 1000], (200, 1)))
    rows[:3] = 0
    codes, scales = negatives.encode(rows, negatives.rotation(64 * -(-size // 64)))
    low, high = negatives.intervals(codes, scales, codes, scales)
    true = rows @ rows.T
    assert (low <= true).all() and (true <= high).all()
    lengths = np.linalg.norm(rows, axis=1)
    big = np.outer(lengths, lengths) > 100
    assert ((high - low)[big] < 0.8 * np.outer(lengths, lengths)[big]).mean() > 0.9


def brute_negatives(rows, every, scale=256):
    usable = {}
    for key, vector, label in rows:
        if key is not None and label is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            whole = [int(np.floor(scale * float(x))) for x in vector]
            usable[key] = min(usable.get(key, (label, whole)), (label, whole))
    size = max((len(v) for _, v in usable.values()), default=0)
    usable = {k: (label, np.array(v + [0] * (size - len(v)), dtype=object)) for k, (label, v) in usable.items()}
    found = []
    for a, (own, v) in usable.items():
        if a % every:
            continue
        scored = sorted((-int(v @ w), k, label) for k, (label, w) in usable.items() if k != a)
        for minus, positive, _ in [s for s in scored if s[2] == own][:5]:
            fit = [(k, -s) for s, k, label in scored if label != own and 50 * -minus <= 100 * -s <= 95 * -minus][:3]
            found += [(a, positive, n, k, -minus, s) for n, (k, s) in enumerate(fit, 1)]
    return sorted(found)


def test_negatives_of_odd_vectors_equal_brute_force(spark):
    rng = random.Random(12)
    f32 = lambda x: float(np.float32(x))
    rows = [(k, [f32(rng.gauss(0, 0.2)) for _ in range(5)], k % 3) for k in range(120)]
    rows += [(k + 200, [0.5, 0.25, 0.0, 0.0, 0.0], k % 3) for k in range(40)]
    rows += [(300, None, 1), (310, [0.1, None], 1), (320, [float("nan")] * 5, 1), (330, [float("inf")] * 5, 0), (340, [0.5], None), (None, [0.5] * 5, 1)]
    rows += [(350, [0.5, 0.25], 0), (360, [], 2), (10, [0.5] * 5, 0), (10, [0.5] * 5, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("clash") for c in ("id", "v", "codes", "group")})
    for group in (4096, 16):
        got = negatives.mine(df.repartition(3), F.col("id") % 5 == 0, group=group).collect()
        assert sorted(tuple(r) for r in got) == brute_negatives(rows, 5) != []
    assert negatives.mine(df.limit(0), F.lit(True)).collect() == []
    one = spark.createDataFrame([(1, [3e18], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="64 bits|overflow|OVERFLOW"):
        negatives.mine(one, F.lit(True)).collect()


def test_audit_of_any_filters_equals_brute_force(spark):
    from itertools import permutations

    rng = random.Random(13)
    rows = [(k if k % 17 else None, rng.choice(["a", "b b", "", None, "c" * 9, f"own{k}"]), rng.choice(["x", None, ""]), k % 5 == 0, None if k % 7 == 0 else k % 3 == 0) for k in range(150)]
    rows += rows[:10]
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 150, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, p boolean, q boolean")
    table = spark.createDataFrame([(k, int(a), int(b)) for k, a, b in labels], "doc_id long, quality int, toxic int")
    found = audit.interactions(docs, table, {"P": F.col("p"), "Q": F.col("q")}, "R").collect()
    least = {}
    for key, text, *_ in rows:
        if key is not None:
            least[text or ""] = min(least.get(text or "", key), key)
    fails = [{"P": p, "Q": bool(q), "R": key is not None and least[text or ""] < key} for key, text, _, p, q in rows]
    good = {k for k, a, _ in labels if a == 1 and k is not None}
    toxic = {k for k, _, b in labels if b and k is not None}
    expected, removed = {}, {}
    for part in ("x", ""):
        own = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        for order in permutations("PQR"):
            for step, name in enumerate(order, 1):
                alive = [k for k in own if not any(fails[k][n] for n in order[: step - 1])]
                gone = [k for k in alive if fails[k][name]]
                removed[part, name] = removed.get((part, name), 0) + len(gone)
                expected[part, "".join(order), step] = (
                    len(alive) - len(gone), len(gone), sum(fails[k][name] for k in own) - len(gone),
                    sum(fails[k][name] and sum(fails[k].values()) == 1 for k in own),
                    sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone), name,
                )
    got = {(r["part"], r["filter_order"], r["step"]): r for r in found}
    assert len(found) == len(got) and set(got) == set(expected)
    for key, own in expected.items():
        r = got[key]
        assert (*[r[c] for c in audit.COUNTS[:-1]], r["filter"]) == own and r["shapley"] == removed[key[0], own[-1]]
    with pytest.raises(ValueError):
        audit.interactions(docs, table, {c: F.col("p") for c in "PQSTUVW"})
