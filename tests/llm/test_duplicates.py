"""Line dedup, the Jaccard join and its parts against plain versions."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_rows import rows_of
from shelfcast.llm import line_dedup, ngram_join
from shelfcast.llm.common import Workspace
from shelfcast.llm.components import connected_components
from shelfcast.llm.count_tree import CountTree, links

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- line dedup

def later_copies(rows, min_words):
    """Text, lines and deleted lines by row: every stretch of lines compared with all that begin earlier."""
    texts = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, deleted = set(), {}
    for row in texts:
        lines = row[1].split("\n")
        filled = [k for k, x in enumerate(lines) if WORD.search(x)]
        words = [len(WORD.findall(lines[k])) for k in filled]
        gone = set()
        stretches = []
        for s in range(len(filled)):
            for e in range(s, len(filled)):
                if sum(words[s : e + 1]) >= min_words:
                    stretches.append((s, e, tuple(lines[k] for k in filled[s : e + 1])))
        # equal stretches of one text: the later start is the copy
        for s, e, key in sorted(stretches):
            if key in seen:
                gone.update(range(s, e + 1))
            seen.add(key)
        # blank lines between two deleted lines go with them
        deleted[row] = {filled[k] for k in gone} | {
            x for k in gone if k + 1 in gone for x in range(filled[k], filled[k + 1])
        }
    out = []
    for row in rows:
        lines = row[1].split("\n") if row[1] is not None else []
        gone = deleted.get(row, set())
        kept = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        out.append((row[0], row[1] if not gone else kept, len(lines), len(gone)))
    return out


def test_line_dedup_equals_brute_force(spark):
    random.seed(3)
    pool = ["a b c", "d", "e f", "g h i j", "", "k l", "m n o p q"]
    rows = [(i, "\n".join(random.choice(pool) for _ in range(random.randint(0, 9)))) for i in range(40)]
    rows += [(70, "a b c\n" * 12), (71, "x y\nz w\n" * 6), (72, "\n\n"), (73, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    min_words = 9
    found = line_dedup.delete_later_copies(docs, min_words)
    assert Counter(rows_of(found)) == Counter(later_copies(rows, min_words))


def test_line_dedup_edges(edge_docs, clashing_docs, no_docs):
    rows = rows_of(edge_docs, "doc_id", "text")
    found = rows_of(line_dedup.delete_later_copies(edge_docs, 20))
    assert Counter(rows_of(line_dedup.delete_later_copies(clashing_docs, 20))) == Counter(found)
    assert len(found) == len(rows)
    by_id = Counter((i, t, d) for i, t, _, d in found)
    paragraph = next(t for i, t in rows if i == 5)
    assert by_id[5, paragraph, 0] == 1
    # two equal rows are one document, the copy of the one before
    assert by_id[6, "", 1] == 2
    assert by_id[2, None, 0] == by_id[3, "", 0] == by_id[4, " \n\t \n", 0] == 1
    kept = line_dedup.delete_later_copies(clashing_docs, 20, keep=("id", "n_tokens", "kept")).select("kept.*")
    assert kept.columns == ["id", "n_tokens", "kept"]
    assert rows_of(line_dedup.delete_later_copies(no_docs, 20)) == []


def test_line_dedup_runs_no_python(edge_docs):
    plan = line_dedup.delete_later_copies(edge_docs, 50)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- components

@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(9, 3), (3, 9), (4, 9), (7, 8)],
])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    found = dict(rows_of(connected_components(Workspace(spark), df, "c")))
    label = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found == label


# -- Jaccard join

def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= width:
        return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))
    return frozenset([tuple(words)] if words else [])


def jaccard_groups(rows, width, percent):
    """(id, size, least id of the component) by row."""
    sets = [shingles(t, width) for _, t in rows]
    label = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label = [new if x == old else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label):
        least[x] = min([v for v in (least.get(x), i) if v is not None], default=None)
    return [(i, len(s), least[x] if s else i) for (i, _), s, x in zip(rows, sets, label)]


def altered(random_, words, n):
    words = list(words)
    for _ in range(n):
        words[random_.randrange(len(words))] = f"new{random_.randrange(10**6)}"
    return words


def varied_rows():
    r = random.Random(5)
    rows = []
    for size in (1, 2, 3, 9, 12, 14, 15, 30, 60, 120, 400):
        base = [f"w{r.randrange(50)}x{size}" for _ in range(size)]
        rows += [(len(rows) + k, " ".join(altered(r, base, k // 2))) for k in range(7)]
        rows.append((len(rows), " ".join([*base, *altered(r, base, 3)[: size // 12]])))
    return rows


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_join_equals_brute_force(spark, width, percent):
    rows = varied_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(rows_of(ngram_join.jaccard_components(docs, width, percent))) == sorted(jaccard_groups(rows, width, percent))


def test_join_of_large_families_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 300)
    rows = varied_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(rows_of(ngram_join.jaccard_components(docs, 3, 80))) == sorted(jaccard_groups(rows, 3, 80))


@pytest.mark.parametrize("meet", [2, 3])
def test_join_with_crowded_keys(spark, monkeypatch, meet):
    """Keys of more sets than are paired: whole clusters, and phrases that many texts hold."""
    monkeypatch.setattr(ngram_join, "MEET", meet)
    r = random.Random(6)
    phrases = [" ".join(f"p{k}x{i}" for i in range(9)) for k in range(6)]
    rows = varied_rows() + [(500 + i, t + " " + r.choice(phrases)) for i, t in varied_rows()]
    rows += [(i, t) for i, t in rows[::9]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert Counter(rows_of(ngram_join.jaccard_components(docs, 3, 80))) == Counter(jaccard_groups(rows, 3, 80))


def test_families_hold_no_sets_that_meet_by_chance(spark, monkeypatch):
    """Phrases that some texts happen to share, as ever more do in ever larger tables, don't make a family of them."""
    kept = {}

    def keep(self, df, name, plain=Workspace.keep):
        kept[name] = plain(self, df, name)
        kept[name, "n"] = kept[name].count()
        return kept[name]

    monkeypatch.setattr(Workspace, "keep", keep)
    r = random.Random(7)
    phrases = [" ".join(f"p{k}x{i}" for i in range(3)) for k in range(1500)]
    # each phrase is in four texts or so, each text holds twenty of them and words of its own
    rows = [(k, " ".join(p for x in r.sample(phrases, 20) for p in (x, *(f"w{r.random()}" for _ in range(8))))) for k in range(300)]
    rows += [(1000 + k, " ".join(altered(r, t.split(" "), 1))) for k, t in rows[:10]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join.jaccard_components(docs, 3, 80)
    assert sorted(rows_of(found)) == sorted(jaccard_groups(rows, 3, 80))
    assert sum(i != c for i, _, c in rows_of(found)) == 10
    assert kept["members", "n"] <= 30


def test_join_edges(spark, edge_docs, clashing_docs, no_docs):
    rows = rows_of(edge_docs, "doc_id", "text")
    want = Counter(jaccard_groups(rows, 3, 80))
    docs = clashing_docs
    assert Counter(rows_of(ngram_join.jaccard_components(docs, 3, 80))) == want
    one = ngram_join.one_of_each(docs, 3, 80)
    assert one.columns == docs.columns
    kept = Counter(i for (i,) in rows_of(one, "doc_id"))
    # the altered copy has the least id of its group; rows without words all stay
    assert kept == Counter([1, 2, 3, 4, None, -10, 7, 8, 9, None] + [6] * (kept[6]))
    assert kept[6] == sum(1 for i, _, c in want if i == 6 and c == 6)
    assert rows_of(ngram_join.jaccard_components(no_docs, 3, 80)) == []
    assert rows_of(ngram_join.one_of_each(no_docs, 3, 80)) == []


@settings(max_examples=200, deadline=None)
@given(st.integers(60, 95), st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 2**32))
def test_similar_sets_share_a_key(percent, n, only_a, only_b, seed):
    values = np.random.default_rng(seed).integers(0, 2**63, n + only_a + only_b, dtype=np.uint64)
    values = np.unique(values)
    a, b = np.sort(values[: n + only_a]), np.sort(np.concatenate([values[:n], values[n + only_a :]]))
    if not len(b) or 100 * len(np.intersect1d(a, b)) < percent * len(np.union1d(a, b)) or len(a) == len(b) == n:
        return
    blocks = ngram_join.Blocks(percent)
    assert set(blocks.keys(a).tolist()) & set(blocks.keys(b).tolist())


@settings(max_examples=200, deadline=None)
@given(st.integers(60, 95), st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 2**32))
def test_similar_sets_share_most_keys(percent, n, only_a, only_b, seed):
    """In the class of the smaller one they agree in all filled blocks of the first cut but one for each differing shingle."""
    values = np.unique(np.random.default_rng(seed).integers(0, 2**63, n + only_a + only_b, dtype=np.uint64))
    np.random.default_rng(seed).shuffle(values)
    a, b = np.sort(values[: n + only_a]), np.sort(np.concatenate([values[:n], values[n + only_a :]]))
    blocks, common = ngram_join.Blocks(percent), np.sort(values[::5])
    differ = len(a) + len(b) - 2 * n
    if 100 * n < percent * len(values) or min(len(a), len(b)) < blocks.bounds[0]:
        return
    assert differ <= (len(a) + len(b)) * (100 - percent) // (100 + percent)
    c = blocks.classes(min(len(a), len(b)))[-1]
    keys = []
    for x in (a, b):
        found = blocks.keys(x, common)
        assert differ <= blocks.most(len(x))[c - blocks.classes(len(x))[0]]
        keys.append(set(found[found & np.uint64((2 << ngram_join.CLASS_BITS) - 1) == np.uint64(c)].tolist()))
    assert len(keys[0] & keys[1]) >= max(map(len, keys)) - differ


def test_tree_finds_all_links():
    r = np.random.default_rng(2)
    base = [r.integers(0, 2**63, 200, dtype=np.uint64) for _ in range(6)]
    sets = [np.unique(np.concatenate([b[k:], r.integers(0, 2**63, k, dtype=np.uint64)])) for b in base for k in range(0, 40, 2)]
    label = list(range(len(sets)))
    for i, j in combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label = [new if x == old else x for x in label]
    found = list(range(len(sets)))
    for i, j in links(sets, 80):
        old, new = max(found[i], found[j]), min(found[i], found[j])
        found = [new if x == old else x for x in found]
    assert found == label
    tree = CountTree(np.zeros((100, 32), np.int32), np.arange(100))
    assert sorted(np.concatenate([m for m, c in zip(tree.members, tree.children) if c is None]).tolist()) == list(range(100))
