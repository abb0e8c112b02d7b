import math
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from test_documents import SPACE, hits, verdicts_by_hand
from newsloom.llm import frames, queries
from newsloom.llm.decontaminate import clean_only
from newsloom.llm.jaccard_join import one_of_each
from newsloom.llm.quality_rules import quality_rules
from newsloom.llm.sampling import decode, round_trip
from newsloom.llm.substring_dedup import cut_repeats


def test_stages_and_run(spark, sf):
    docs = frames.table(spark, sf, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "sentencepiece_coding"]
    step = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        step = frames.stored(stage(spark, step, sf), "test")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert step.columns == columns
    # The same by hand, each operator's result by its own tested form.
    kept = quality_rules(docs).where("kept").select("doc_id")
    by_hand = cut_repeats(frames.stored(one_of_each(frames.stored(docs.join(kept, "doc_id", "left_semi").select(*columns), "test")), "test"))
    by_hand = clean_only(frames.stored(by_hand, "test"), frames.table(spark, sf, "benchmark"))
    expected = {r["doc_id"]: r["n_pieces"] for r in round_trip(by_hand).collect()}
    assert {r["doc_id"]: r["n_pieces"] for r in step.collect()} == expected
    out = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"]: r["n_pieces"] for r in out.collect()} == expected
    assert out.where("not lossless").count() == 0 and max(Counter(r["doc_id"] for r in out.collect()).values()) == 1


def test_every_query_has_its_columns(spark, sf):
    wanted = {
        "op1": ["page_id", "url", "text", "n_chars"],
        "op2": ["doc_id", "n_words", "n_removed", "kept_sha256"],
        "op3": ["doc_id", "class_id", "n_links"],
        "op4": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        "op5": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
        "op6": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
        "op7": ["doc_id", "n_pieces", "ids_sha256", "lossless"],
        "op8": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        "op9": ["doc_id", "n_tokens"],
        "op10": ["doc_id", "held_out", "score", "predicted"],
        "op11": ["word", "form", "root", "n", "n_near", "form_n"],
        "op12": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
        "op13": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    }
    for name, query in queries.QUERIES.items():
        assert set(wanted[name.split("_")[0]]) <= set(query(spark, sf).columns)


def by_hand(rows, items):
    """(doc_id, text) that the pipeline leaves, in plain Python. rows: doc_id, text, lang."""
    kept = [(i, t) for (i, t, _), v in zip(rows, verdicts_by_hand(rows), strict=True) if v[1]]
    # One of each class of texts whose five-word shingles have a Jaccard similarity of 0.8 or more.
    first = {}
    for i, t in kept:
        first[t] = min(first.get(t, math.inf), math.inf if i is None else i)
    sets = {}
    for t in first:
        w = SPACE.findall(t)
        sets[t] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)}
    group = {t: t for t in first}
    for a in first:
        for b in first:
            if a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                old, new = group[a], group[b]
                group = {t: new if g == old else g for t, g in group.items()}
    best = {}
    for t, g in group.items():
        best[g] = min(best.get(g, (math.inf, t)), (first[t], t))
    one = [(None if i == math.inf else i, t) for i, t in best.values()]
    # Passages that a smaller document has go; then documents with a benchmark window.
    out = []
    for i, t in one:
        w, alone = SPACE.findall(t), removed_words(one, i, t)
        if len(alone) == len(w):
            out.append((i, t))
        elif alone:
            out.append((i, " ".join(alone)))
    return [(i, t) for i, t in out if not hits([(i, t)], items)[0][-1]]


def removed_words(rows, doc_id, text, window=50):
    """The words of one document that stay."""
    own = math.inf if doc_id is None else doc_id
    seen = set()
    for i, t in rows:
        if (math.inf if i is None else i) < own:
            w = SPACE.findall(t)
            seen |= {tuple(w[p : p + window]) for p in range(len(w) - window + 1)}
    w = SPACE.findall(text)
    gone = {q for p in range(len(w) - window + 1) if tuple(w[p : p + window]) in seen for q in range(p, p + window)}
    return [x for k, x in enumerate(w) if k not in gone]


@pytest.fixture
def tables(make, spark, tmp_path):
    """Writes documents (with columns of clashing names) and benchmark, and gives the folder."""

    def write(rows, items, langs=None):
        make(rows, langs).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame(items, "item_id long, text string").write.mode("overwrite").parquet(str(tmp_path / "benchmark.parquet"))
        return str(tmp_path)

    return write


def test_pipeline_against_plain_python(spark, sf, tables):
    from conftest import odd_rows

    rng = np.random.default_rng(9)
    prose = [r["text"] for r in frames.table(spark, sf, "documents").where("lang = 'en' and length(text) between 800 and 4000").orderBy("doc_id").limit(12).collect()]
    rows = odd_rows()
    for n, t in enumerate(prose):
        w = t.split()
        changed = [x if rng.random() > 0.005 else f"z{n}" for x in w]
        passage = " ".join(prose[(n + 1) % len(prose)].split()[:70])
        rows += [(100 + n, t), (200 + n, " ".join(changed)), (300 + n, t), (400 + n, " ".join(w[::-1]) + " " + passage), (400 + n, " ".join(sorted(w)) + " end")]
    rows += [(None, prose[0] + " " + prose[3]), (500, None), (501, "")]
    items = [(1, " ".join(prose[2].split()[30:45])), (2, None), (None, "the"), (3, "w1 w2 w3")]
    at = tables(rows, items)
    out = corpus_pipeline.run(spark, at)
    assert out.where("not lossless").count() == 0
    got = Counter((r["doc_id"], r["text"]) for r in decode(out).collect())
    want = Counter(by_hand([(i, t, "en") for i, t in rows], items))
    assert got == want and len(got) > 10


def test_pipeline_of_nothing(spark, tables):
    assert corpus_pipeline.run(spark, tables([], [(1, "a b c")])).count() == 0
    assert corpus_pipeline.run(spark, tables([(1, None), (2, "")], [])).count() == 0
