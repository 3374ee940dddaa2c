"""Toxicity, personal data and language-model scores: plain versions, properties and held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_rows import rows_of
from shelfcast.llm import lm_scoring, pii, toxicity
from shelfcast.llm.common import Workspace
from shelfcast.llm.queries import fold

DATA = "/root/testdata/sf0.01"


def held_out(doc_id, parts):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == 1


# -- toxicity

def test_clauses_compose():
    machine, i = toxicity.grammar(), toxicity
    plain = machine.clause([(4, i.INSULT, 3.0)])
    assert machine.clause([(3, i.TARGET, 0), (4, i.INSULT, 3.0)]) > plain
    assert machine.clause([(3, i.NEGATION, 0), (4, i.INSULT, 3.0)]) < plain
    assert machine.clause([(0, i.REPORT, 0), (9, i.INSULT, 3.0)]) < plain
    # a denial is forgotten after three words, a report is not within its clause
    assert machine.clause([(0, i.NEGATION, 0), (9, i.INSULT, 3.0)]) == plain
    assert machine.clause([(3, i.INTENT, 0), (4, i.THREAT, 3.0)]) > machine.clause([(4, i.THREAT, 3.0)])
    assert machine.clause([]) == 0


def test_a_word_weighs_where_it_weighs_most():
    texts = ["he said that trash is a word. you trash", "you trash now. he said that trash is", "you trash", "you trash now. you trash"]
    x = toxicity.features(pa.array([*texts, "he said that trash is a word"]), toxicity.Lexicon({"trash": 3.0}), toxicity.grammar())
    assert x[:4, :3] == pytest.approx(np.tile(x[2, :3], (4, 1)))
    assert x[0, 1] > x[4, 1] > 0


def test_stems_are_the_narrowest_that_serve():
    toxic = {"tra": 50, "tras": 50, "trash": 50, "veq": 40, "vequ": 40, "vequa": 12, "the": 60}
    clean = {"tra": 0, "veq": 0, "the": 900}
    kept = toxicity.chosen_stems(toxic, clean, 100, 1000)
    assert set(kept) == {"trash", "vequ"}


def test_toxicity_edges(edge_docs, clashing_docs, no_docs, labels, spark):
    for given_labels in (labels, labels.limit(0)):
        found = toxicity.score(edge_docs, given_labels, fold(3, "doc_id"))
        rows = rows_of(found, "doc_id", "held_out", "score", "predicted")
        assert Counter((i, h) for i, h, _, _ in rows) == Counter((i, held_out(i, 3)) for (i,) in rows_of(edge_docs, "doc_id"))
        assert all(0 <= s <= 1 and p == (s >= 0.7) for _, _, s, p in rows)
    kept = toxicity.score(clashing_docs, labels, fold(3, "doc_id"), keep=("kept", "score", "text"))
    assert kept.select("kept.*").columns == ["kept", "score", "text"]
    assert Counter(rows_of(kept, "kept.text")) == Counter(rows_of(edge_docs, "text"))
    assert rows_of(toxicity.score(no_docs, labels, fold(3, "doc_id"))) == []


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    labelled = labels.select("doc_id", "toxic").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    scored = toxicity.score(docs, labels, fold(3, "doc_id")).join(labelled, "doc_id").where("held_out")
    n = Counter(rows_of(scored, "toxic", "predicted"))
    # some rows labelled toxic hold no word that others do
    assert n[1, 1] / (n[1, 1] + n[1, 0]) >= 0.9
    assert n[0, 0] / (n[0, 0] + n[0, 1]) >= 0.99


# -- personal data

#: The base patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(d) for d in re.findall("[0-9]", m[0])]
            doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and (not 13 <= len(digits) <= 19 or sum(doubled) % 10):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("0123456789.+- ()@ab%_é"), max_size=60) | st.text(st.sampled_from("41 -."), max_size=45))
def test_base_spans(text):
    assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == base(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "a@" * 50_000, "1." * 100_000, "+1" + " " * 100_000):
        pii.base_spans(text)
        pii.loose_spans(text, [])


def test_digest(edge_docs, clashing_docs, no_docs, spark):
    rows = rows_of(edge_docs, "doc_id", "text")
    rows += [(20, "call +1 (366) 555-9807 or 4111 1111 1111 1111, 10.0.0.1 or 10.0.0.256, a@b.c"), (21, "é+1 (2) 3456 7890")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("own"))
    want = Counter()
    for i, t in rows:
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base(t))
        n = Counter(k for k, _, _ in base(t))
        want[i, *(n[k] for k in PATTERNS), hashlib.sha256(listed.encode()).hexdigest()] += 1
    found = rows_of(pii.digest(docs))
    assert Counter(r[:6] for r in found) == want
    for r in found:
        spans = [s for s in r[6].split(",") if s]
        assert set(f"{k}:{a}:{b}" for k, a, b in base(dict(rows)[r[0]] if r[0] in (20, 21) else "")) <= set(spans)
    assert len(rows_of(pii.digest(clashing_docs))) == edge_docs.count()
    assert rows_of(pii.digest(no_docs)) == []


def test_reliabilities_are_found():
    r = np.random.default_rng(8)
    truth = r.random(20_000) < 0.3
    right = np.array([0.95, 0.9, 0.7, 0.8, 0.85, 0.6])
    votes = np.where(r.random((20_000, 6)) < right, truth[:, None], ~truth[:, None]).astype(int)
    codes, counts = np.unique(((votes * 2) * 3 ** np.arange(6)).sum(1), return_counts=True)
    shares, p = pii.reliabilities(codes, counts.astype(float))
    assert shares[1, :, 2] == pytest.approx(right, abs=0.03) and shares[0, :, 0] == pytest.approx(right, abs=0.03)
    assert float((p * counts).sum() / counts.sum()) == pytest.approx(0.3, abs=0.05)


def test_candidates_beside_the_base_are_added(spark):
    text = "reach me on +1 (826) 555-4081 190.137.2.9 now"
    assert not [s for s in base(text) if s[0] == "phone"]
    rows = [(i, f"call +1 (366) 555-{1000 + i}, thanks") for i in range(200)] + [(900 + i, text) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = dict(rows_of(pii.digest(docs), "doc_id", "spans"))
    assert "phone:12:29" in spans[900]


def test_mask(edge_docs, clashing_docs, no_docs):
    found = pii.mask(clashing_docs)
    assert found.schema.names == clashing_docs.columns
    texts = {i: t for i, t in rows_of(found, "doc_id", "text")}
    assert texts[1] == "One short text. Mail <EMAIL> now" and texts[2] is None and texts[3] == ""
    unchanged = Counter(r for r in rows_of(edge_docs) if r[0] != 1)
    assert Counter(r for r in rows_of(pii.mask(edge_docs)) if r[0] != 1) == unchanged
    assert rows_of(pii.mask(no_docs)) == []


# -- language model

def test_word_probabilities_are_a_distribution():
    """The probabilities of all one-byte words and beginnings add up to one."""
    tables = np.zeros((lm_scoring.ORDERS, 1 << lm_scoring.SLOT_BITS), np.uint16)
    mixer = lm_scoring.Mixer()
    total = 0.0
    for first in range(256):
        flat = np.array([first], np.uint8)
        hashes, place = lm_scoring.contexts(flat, np.array([0, 1]))
        slots, bits, _ = lm_scoring.bit_slots(flat, hashes)
        codes = np.stack([tables[o][slots[o]] for o in range(lm_scoring.ORDERS)])
        gate, by_place = lm_scoring._gates(lm_scoring.EVIDENCE[codes], place)
        p, _ = mixer.predict(lm_scoring._inputs(lm_scoring.LOG_ODDS[codes]), gate, by_place, np.zeros(8, np.int64))
        total += float(np.where(bits.reshape(-1) == 1, p, 1 - p).prod())
    assert total == pytest.approx(1.0)


def test_contexts_stay_inside_words():
    flat, starts = lm_scoring.token_bytes(["the", "other", "the"])
    hashes, place = lm_scoring.contexts(flat, starts)
    assert (hashes[:, :4] == hashes[:, 10:]).all() and place.tolist() == [0, 1, 2, 3, 0, 1, 2, 3, 4, 5, 0, 1, 2, 3]
    assert (hashes[-1, 4:6] != hashes[-1, :2]).any()


def test_pairs_have_one_key(spark):
    offsets, tokens, before, n_bytes = lm_scoring.sequence(pa.array(["b a  b", "", " a"]))
    assert offsets.tolist() == [0, 4, 5, 7] and n_bytes.tolist() == [7, 1, 3]
    a, b, end = tokens[1], tokens[0], lm_scoring.END_HASH
    assert tokens.tolist() == [b, a, b, end, end, a, end] and before.tolist() == [end, b, a, b, end, end, a]
    pairs = [(int(x), int(y)) for x, y in zip(before.view(np.int64), tokens.view(np.int64))]
    keys = rows_of(spark.createDataFrame(pairs, "a long, b long").select(lm_scoring._key("a", "b")))
    assert [k for (k,) in keys] == lm_scoring.pair_key(before, tokens).tolist()


def test_word_order_counts(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SAMPLE_TOKENS", 4096)
    text = "the old ship left a quiet harbour before dawn"
    shuffled = " ".join(sorted(text.split()))
    rows = [(i, text, False) for i in range(20)] + [(30, text, True), (31, shuffled, True)]
    for frequent in (0, 1 << 15):
        monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
        docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
        scores = dict(rows_of(lm_scoring.score(docs, F.col("held")), "doc_id", "score"))
        assert scores[30] > scores[31] + 5


def test_kinds_come_from_all_training_rows(spark):
    """A kind that a few of thousands of rows hold gets its words."""
    texts = ["alpha beta " * 10] * 4900 + ["gamma delta " * 10] * 97 + ["omega psi psi " * 10] * 3
    rows = spark.createDataFrame([(i, t, False) for i, t in enumerate(texts)], "id long, text string, held_out boolean")
    markers, log_p = lm_scoring._learn_kinds(Workspace(spark), rows)
    assert markers == ["alpha", "beta", "delta", "gamma", "psi", "omega"]
    found = np.array([[t.split().count(m) for m in markers] for t in (texts[0], texts[4900], texts[-1])]) @ log_p.T
    kinds = found.argmax(1)
    assert len(set(kinds)) == 3
    p = np.exp(log_p)
    assert p.sum(1) == pytest.approx(1) and p[kinds[0], 0] > 0.45 and p[kinds[1], 3] > 0.45 and p[kinds[2], 4] > 0.2


def test_every_word_teaches_the_mixer(spark, monkeypatch):
    """Weights of all tasks count by the bits they saw, so each bit of each word is in them once."""
    monkeypatch.setattr(lm_scoring, "SAMPLE_TOKENS", 100)
    words = [f"word{i}" for i in range(700)]
    tables = np.zeros((lm_scoring.ORDERS, 1 << lm_scoring.SLOT_BITS), np.uint16)
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(5)
    mixer = lm_scoring.fit_mixer(df, len(words), spark.sparkContext.broadcast(tables))
    bits = 8 * sum(len(w) + 1 for w in words)
    assert [t.sum() for t in mixer.taught] == pytest.approx([bits] * 3)
    # few words are gone over again
    few = lm_scoring.fit_mixer(df.limit(10), 10, spark.sparkContext.broadcast(tables))
    assert few.taught[0].sum() >= 100 * 6 * 8


def test_merged_mixers_are_their_mean():
    one, two = lm_scoring.Mixer(), lm_scoring.Mixer()
    one.by_place[3], two.by_place[3] = 1.0, 4.0
    one.taught[1][3], two.taught[1][3] = 2, 1
    merged = lm_scoring.Mixer.of_state(one.state() + two.state())
    assert merged.by_place[3] == pytest.approx([2.0] * 6)
    assert (merged.by_evidence == lm_scoring.Mixer().by_evidence).all() and (merged.refined == one.refined).all()


def test_words_that_begin_alike_score_as_alone():
    tables = np.random.default_rng(3).integers(0, 1 << 16, (lm_scoring.ORDERS, 1 << lm_scoring.SLOT_BITS)).astype(np.uint16)
    words = ["the", "then", "there", "them", "the", lm_scoring.END, "é", "other"]
    alone = [lm_scoring.word_scores([w], tables, lm_scoring.Mixer())[0] for w in words]
    assert lm_scoring.word_scores(words, tables, lm_scoring.Mixer()) == pytest.approx(alone, rel=1e-12)


@pytest.mark.parametrize("often", [[], ["a", lm_scoring.END]])
def test_scores_by_definition(monkeypatch, often):
    """Pairs of two stretches, counted and answered in three parts, against the plain formula."""
    texts = [(1, "a b a c", False), (2, "a b b", False), (3, "c a b z", True), (4, "", False), (5, "z a z", True), (6, "a b", False)]
    kind_of, parts, log_p = {1: 0, 2: 1, 4: 0, 6: 1}, 3, {}
    tokens = {i: [*t.split(), lm_scoring.END] for i, t, _ in texts}
    vocabulary = sorted({w for x in tokens.values() for w in x})
    by_kind = [Counter(w for i, k in kind_of.items() if k == kind for w in tokens[i]) for kind in range(lm_scoring.KINDS)]
    total, pairs = sum(by_kind, Counter()), Counter(p for i in kind_of for p in zip([lm_scoring.END, *tokens[i]], tokens[i]))
    n = np.array([sum(c.values()) for c in by_kind], float)
    of_kind = np.array([len(c) for c in by_kind] + [len(total)], float)
    spelled, d = {w: -1.0 - k for k, w in enumerate(vocabulary)}, lm_scoring.DISCOUNT
    for kind, c in enumerate(by_kind):
        for w in vocabulary:
            back = (max(total[w] - d, 0) + d * len(total) * 10 ** spelled[w]) / n.sum()
            log_p[kind, w] = (max(c[w] - d, 0) + d * len(c) * back) / n[kind] if n[kind] else back
    after = Counter(a for a, _ in pairs)
    prior = np.log10(np.full(lm_scoring.KINDS, 1 / lm_scoring.KINDS))

    def plain(words):
        joint = []
        for kind in range(lm_scoring.KINDS):
            p = 1.0
            for a, b in zip([lm_scoring.END, *words], words):
                share = max(pairs[a, b] - d, 0) + d * after[a] * log_p[kind, b]
                p *= share / total[a] if total[a] else log_p[kind, b]
            joint.append(p / lm_scoring.KINDS)
        return math.log10(sum(joint))

    def hashes(words):
        return lm_scoring.word_hash(pa.array(words, pa.string()))

    class Known:
        value = hashes(often)

    monkeypatch.setattr(lm_scoring, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 7})())}))
    rows = [pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*some)], names=["id", "text", "held_out"])
            for some in (texts[:3], texts[3:])]
    stretches = pa.Table.from_batches(lm_scoring._stretches(iter(rows)))
    asked = pa.Table.from_batches(lm_scoring._asked_pairs(Known, parts)(iter(stretches.to_batches())))
    counted = [lm_scoring._counted_pairs(asked.filter(pa.array(np.array(asked["part"]) == p))) for p in set(asked["part"].to_pylist())]
    counted = pa.concat_tables(counted)
    followers = Counter()
    for a, v in zip(counted["a"].to_pylist(), counted["v"].to_pylist()):
        if a is not None:
            followers.update(dict(zip(np.frombuffer(a, np.int64).tolist(), lm_scoring._unpacked(v).tolist())))
    keys = hashes(vocabulary).view(np.int64)
    assert followers == Counter({k: after[w] for k, w in zip(keys.tolist(), vocabulary) if after[w]})
    held = pa.table({"b": keys, "spelled": np.array([spelled[w] for w in vocabulary]), "v": [after[w] for w in vocabulary],
                     **{f"c{k}": [c[w] for w in vocabulary] for k, c in enumerate(by_kind)}})
    words = pa.Table.from_batches(lm_scoring._asked_words(parts)(iter(stretches.select(["stretch", "words"]).to_batches())))
    found = [lm_scoring._found_words(words.filter(pa.array(np.array(words["part"]) == p)), held) for p in set(words["part"].to_pylist())]
    answers = pa.concat_tables([counted.drop_columns(["a", "v"]), *found])
    score = lm_scoring._row_scores(Known, parts, n, of_kind, prior)
    scores = {}
    for k, stretch in enumerate(stretches["stretch"].to_pylist()):
        own = answers.filter(pa.array([x == stretch for x in answers["stretch"].to_pylist()]))
        result = score(stretches.slice(k, 1), own)
        scores.update(zip(result["id"].to_pylist(), result["score"].to_pylist()))
    assert scores == pytest.approx({i: plain(tokens[i]) for i in tokens}, rel=1e-6)


def test_pairs_are_kept_without_scores(spark, monkeypatch):
    """What lies staged for the pairs of a text stays in proportion to it."""
    kept = {}

    def keep(self, df, name, plain=Workspace.keep):
        out = plain(self, df, name)
        files = spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        kept[name] = files.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(files).getLength()
        return out

    monkeypatch.setattr(Workspace, "keep", keep)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert lm_scoring.score(docs, fold(5, "doc_id")).count() == docs.count()
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    of_pairs = sum(size for name, size in kept.items() if name not in ("markers", "counted", "tables"))
    assert of_pairs <= 2.5 * n_bytes, kept


def base_scores(rows, parts):
    tokens = {k: [*(t or "").encode().lower().split(), "end"] for k, (_, t) in enumerate(rows)}
    counts = Counter(x for k, (i, _) in enumerate(rows) if not held_out(i, parts) for x in tokens[k])
    n, v = sum(counts.values()), len(counts)
    return [
        (i, held_out(i, parts), len(tokens[k]), sum(counts[x] > 0 for x in tokens[k]), n,
         round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens[k]), 6))
        for k, (i, _) in enumerate(rows)
    ]


def test_language_model_edges(edge_docs, clashing_docs, no_docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "FREQUENT", 8)
    monkeypatch.setattr(lm_scoring, "SAMPLE_TOKENS", 4096)
    want = Counter(base_scores(rows_of(edge_docs, "doc_id", "text"), 5))
    docs = clashing_docs
    rows = rows_of(lm_scoring.score(docs, fold(5, "doc_id")))
    assert Counter((*r[:5], round(r[5], 6)) for r in rows) == want
    assert all(r[6] < 0 and r[7] > 0 for r in rows)
    assert rows_of(lm_scoring.score(no_docs, fold(5, "doc_id"))) == []
    # nothing to learn from
    nothing = rows_of(lm_scoring.score(edge_docs.where("doc_id = 5"), F.lit(True)))
    assert [r[3:5] for r in nothing] == [(0, 0)] and nothing[0][6] < 0


def test_language_model_beats_the_base_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = rows_of(lm_scoring.score(docs, fold(5, "doc_id")))
    want = base_scores(rows_of(docs, "doc_id", "text"), 5)
    assert sorted(r[:5] for r in rows) == sorted(w[:5] for w in want)
    assert [r[5] for r in sorted(rows)] == pytest.approx([w[5] for w in sorted(want)], rel=1e-8, abs=1e-6)
    unseen = [r for r in rows if r[1] and r[3] == r[2]]
    assert unseen and np.mean([r[6] > r[5] for r in unseen]) > 0.8
