"""The n-gram join against comparing all pairs."""

import random

import pandas as pd
import pytest

from feedworks.llm import ngram_join
from feedworks.llm.components import _state, connected_components
from feedworks.llm.ngram_join import jaccard_links, keep_one_of_each_group, keep_one_row_of_each_group, prefix_length, shingle_set

WORDS = [f"w{i}" for i in range(500)]


def plain_set(text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def plain_join(rows, threshold=0.8):
    sets = [plain_set(t) for _, t in rows]
    group = list(range(len(rows)))
    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {}
    for (doc, _), g in zip(rows, group):
        first[g] = min(first.get(g, doc), doc)
    return {doc: (first[g], n) for (doc, _), g, n in zip(rows, group, links)}


def corpus(seed, documents=60, copies=6):
    draw = random.Random(seed)
    texts = []
    for _ in range(documents):
        words = draw.choices(WORDS, k=draw.choice([1, 3, 5, 8, 40, 90, 300]))
        texts.append(words)
        for _ in range(draw.randrange(copies)):
            other = list(words)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 4, 8])):
                other[draw.randrange(len(other))] = draw.choice(WORDS)
            texts.append(other)
    draw.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)] + [(10_000 + i, t) for i, t in enumerate(["", None, " \n", "\t"])]


def found(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_links(df, **settings).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == plain_join(rows)


def test_clusters_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "BROADCAST_MEMBERS", 3)
    rows = corpus(3, documents=8, copies=40)
    assert found(spark, rows) == plain_join(rows)


def test_blocks_count_each_pair_once():
    rows = corpus(4, documents=3, copies=12)
    sets = [shingle_set(t.encode()) for _, t in rows if t and t.strip()]
    table = pd.DataFrame({"class_no": range(len(sets)), "copies": 1, "hashes": [s.tobytes() for s in sets]})
    alone = ngram_join.compare_blocks(table.assign(i=0, j=0, side=0), 0.8)
    gains = alone[alone.b == -1].groupby("a").gain.sum()
    half = len(sets) // 2
    parts = [table[:half].assign(i=0, j=0, side=0), table[half:].assign(i=1, j=1, side=0)]
    parts.append(pd.concat([table[:half].assign(side=0), table[half:].assign(side=1)]).assign(i=0, j=1))
    split = pd.concat([ngram_join.compare_blocks(p, 0.8) for p in parts])
    assert split[split.b == -1].groupby("a").gain.sum().equals(gains)


def test_prefixes_shorten_until_the_recall_holds():
    for recall in (0.9, 0.99, 0.99999):
        length = prefix_length(0.8, recall)
        missed = (1 - 0.8**length) ** ngram_join.TREES
        assert missed <= 1 - recall
        longer = length + 1
        assert length == ngram_join.DEPTH or (1 - 0.8**longer) ** ngram_join.TREES > 1 - recall
    assert prefix_length(0.8, 0.9) > prefix_length(0.8, 0.99999)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [
        (None, "a b c d e f", 1), (5, "a b c d e f", 2), (5, "a b c d e f", 2), (3, "a  b c\nd e f", 3),
        (7, "a b", 4), (8, "a b", 5), (8, "something else", 6), (9, None, 7),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_id int")
    got = sorted(((r["doc_id"] or 0), r["class_id"], r["n_links"]) for r in jaccard_links(df).collect())
    assert got == [(0, 3, 3), (3, 3, 3), (5, 3, 3), (5, 3, 3), (7, 7, 1), (8, 7, 1), (8, 8, 0), (9, 9, 0)]
    kept = keep_one_of_each_group(df)
    assert kept.columns == df.columns
    # Id 8 goes for its first text: ids name documents.
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 9]
    assert jaccard_links(df.limit(0)).count() == 0
    assert keep_one_of_each_group(df.limit(0)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    draw = random.Random(5)
    names = draw.sample(range(10**12), 400)
    edges = [(names[i], names[i + 1]) for i in range(199)]  # a chain
    edges += [(names[200], x) for x in names[201:300]]  # a star
    edges += [(names[300], names[300]), (names[5], names[5])]
    edges += [tuple(draw.sample(names[310:], 2)) for _ in range(60)]
    draw.shuffle(edges)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    df = spark.createDataFrame(edges + edges[:50], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {x: root(x) for x in parent}
    assert connected_components(df.limit(0)).count() == 0


def test_the_digest_of_very_many_edges_does_not_overflow(spark):
    edges = spark.range(1 << 25).selectExpr("id + 1 as v", "0L as u")
    state = _state(edges)
    assert state == _state(edges.repartition(3)) and state[0] == 1 << 25
    assert _state(edges.where("v <> 77"))[1:] != state[1:]


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_one_row_of_each_group_stays_whatever_the_ids(spark, monkeypatch, broadcast):
    monkeypatch.setattr(ngram_join, "BROADCAST_MEMBERS", broadcast)
    near = " ".join(WORDS[:90])
    kept = [
        (5, "a b c d e f"), (None, "alone here"), (None, "only  null twice"), (7, "a b"), (8, "something else"),
        (3, "x y"), (3, "z z z"), (None, ""), (None, None), (8, " "),
    ]
    gone = [(None, "a b c d e f"), (None, "only null twice"), (8, "a b"), (12, "something  else"), (3, "x y")]
    rows = [(d, t, {"k": 1}) for d, t in kept + gone + [(20, near), (20, near + " other"), (None, near)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, first_id map<string,int>")
    left = keep_one_row_of_each_group(df)
    assert left.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str)
    assert len(got) == len(kept) + 1
    assert [x for x in got if x[0] != 20] == sorted(kept, key=str)
    assert keep_one_row_of_each_group(df.limit(0)).count() == 0
    # Ids drawn from a few, or null: by row numbers, one of each group with its smallest id stays.
    draw = random.Random(6)
    texts = [t for _, t in corpus(6)]
    ids = [draw.choice([None, *range(40)]) for _ in texts]
    df = spark.createDataFrame(list(zip(ids, texts, range(len(ids)))), "doc_id long, text string, row int")
    groups = {i: g for i, (g, _) in plain_join(list(enumerate(texts))).items()}
    want = {g: min((ids[i] is None, ids[i] or 0) for i in groups if groups[i] == g) for g in set(groups.values())}
    left = [r["row"] for r in keep_one_row_of_each_group(df).collect()]
    assert sorted(groups[i] for i in left) == sorted(want)
    assert all((ids[i] is None, ids[i] or 0) == want[groups[i]] for i in left)


def test_distinct_ids_keep_the_same_rows_both_ways(spark):
    df = spark.createDataFrame(corpus(7), "doc_id long, text string")
    by_row, by_id = keep_one_row_of_each_group(df), keep_one_of_each_group(df)
    assert sorted(r["doc_id"] for r in by_row.collect()) == sorted(r["doc_id"] for r in by_id.collect())


@pytest.mark.parametrize("name", [lambda i: i, lambda i: None, lambda i: 5, lambda i: i % 7])
def test_rows_bring_along_their_own_class_only(spark, monkeypatch, name):
    """However ids repeat, as many texts reach the exact check as there are classes in clusters."""
    rows = [(name(i), text) for i, (_, text) in enumerate(corpus(4, documents=40, copies=8))]
    rows += [rows[0]] * 30
    asked, good = [], ngram_join.member_sets

    def member_sets(texts, members):
        sets = good(texts, members)
        same = texts["doc_id"].eqNullSafe(members["first_id"]) & (texts["text_mark"] == members["first_text"])
        asked.append((texts.join(members, same).count(), members.count(), sets.count()))
        return sets

    monkeypatch.setattr(ngram_join, "member_sets", member_sets)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    links = [r["n_links"] for r in jaccard_links(df).collect()]
    (joined, members, sets), = asked
    assert members == sets and joined <= len(rows)
    plain = plain_join(list(enumerate(t for _, t in rows)))
    assert sorted(links) == sorted(n for _, n in plain.values())
