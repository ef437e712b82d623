"""The corpus pipeline against brute force, stage by stage."""

import re

import numpy as np
import pytest
from test_mixing import brute as mixed_by_hand
from test_packing import check_pieces
from test_simhash import brute as grouped_by_hand
from test_substring import brute as cut_by_hand

import corpus_pipeline as P
from rillflow.llm import packing, quality

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")


def by_hand(spark):
    """(doc_id, text) rows that reach the packing, by plain Python but for the quality verdict."""
    kept = {r.doc_id for r in quality.op1_quality_rules(spark, SF).filter("kept").collect()}
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.doc_id in kept]
    source = {r.doc_id: r.source for r in docs}
    rows = [(r.doc_id, r.text) for r in docs]
    stay = {c for _, _, c in grouped_by_hand(rows)}
    rows = [r for r in rows if r[0] in stay]
    rows = [(d, text) for d, _, _, _, text in cut_by_hand(rows)]
    taken = {d: (n, t) for d, n, _, _, t in mixed_by_hand([(d, t, source[d]) for d, t in rows])}
    out = []
    for d, text in rows:
        size, left = taken[d]
        while left > 0:
            part = min(size, left)
            out.append((d, text if part == size else "".join(WORD.findall(text)[:part])))
            left -= part
    return out


def test_run_equals_brute_force(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing._tokenizer_path())
    pieces = P.run(spark, SF).collect()
    used = check_pieces(by_hand(spark), pieces, lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)])
    assert used > 0.95
    assert np.unique([p.sequence_id for p in pieces]).size > 1


def test_stages_return_documents(spark, make_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name


@pytest.mark.parametrize("where", ["true", "false"])
def test_odd_tables_pass_every_stage(spark, make_docs, where):
    rows = [(None, None, None, None), (1, "", "en", None), (2, "word " * 100, None, "s"), (2, "word " * 100, None, "s"), (None, "a b c " * 9000)]
    names = ["size", "kept", "fp", "chunk", "n_words", "Taken", "__q_lines", "Source_Size", "__mix_key", "N_Removed", "__sim_id", "__mix_part", "Posterior"]
    docs = make_docs(rows, [f"{i + 1} AS {c}" for i, c in enumerate(names)]).filter(where)
    for name, stage in P.STAGES:
        out = stage(spark, docs, "")
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns, name
            assert {tuple(r[5:]) for r in out.collect()} <= {tuple(range(1, len(names) + 1))}, name
            assert out.count() <= 2 * len(rows)
        else:
            assert (out.count() > 0) == (where == "true")
