"""Chat formatting: round trips, and masks that cover the assistant's texts exactly."""

import hashlib
import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from rillflow.llm import chat as C

PATH = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = ["<", "|", "\\", ">", "im_end", "<|im_start|>", "<|endoftext|>", " ", "\n", "é", "漢", "😀", "ok", "a", "!", "​"]
texts = st.lists(st.sampled_from(SIGNS), max_size=12).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant", "system", ""]), texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=6))
def test_round_trip_and_mask(turns):
    text, spans = C.render(turns)
    assert C.parse(text) == turns
    t = C.tokenizer_with_controls(PATH)
    e = t.encode(text, add_special_tokens=False)
    starts, ends = np.array(e.offsets, np.int32).reshape(-1, 2).T
    loss = C.mask(spans, starts, ends)
    want = [x for r, x in turns if r == "assistant" and x]
    assert C.learned(text, starts, ends, loss) == want
    runs, on = [], False  # and by the ids alone
    for i, yes in zip(e.ids, loss):
        if yes:
            runs = [*runs, []] if not on else runs
            runs[-1].append(i)
        on = bool(yes)
    assert [C.unescape(t.decode(r, skip_special_tokens=False)) for r in runs] == want


def brute(rows):
    by = {}
    for n, (c, turn, role, text) in enumerate(rows):
        by.setdefault(c if c is not None else ("alone", n), []).append(
            (turn is not None, turn or 0, role or "", text or ""))
    out = []
    for c, turns in by.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((None if isinstance(c, tuple) else c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)),
                    len(loss), sha(loss), len(C.render(turns)[0])))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows(spark):
    r = random.Random(4)
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (2, None, None, None), (2, 3, "assistant", "é😀"),
            (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (None, 0, "user", "x"), (None, 0, "user", "x"),
            (4, 0, "user\nassistant", "<|im_sep|>"), (5, 0, "assistant", "long " * 50000)]
    rows += [(10 + i % 30, i, r.choice(["user", "assistant"]), "".join(r.choice(SIGNS) for _ in range(9))) for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr(
        "*", "1 AS ids", "'x' AS turns", "2 AS n_turns").repartition(3)
    out = C.format_conversations(df, PATH)
    assert got(C.digests(out)) == brute(rows)
    assert got(C.digests(C.format_conversations(df.filter("false"), PATH))) == []


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    rows += [(-1, 0, "user", C.TRICK), (-1, 1, "assistant", C.TRICK)]
    out = got(C.op3_chat(spark, sf))
    assert out == brute(rows)
    trick = [x for x in out if x[0] == -1][0]
    assert trick[1] == 2 and trick[3] == len(C.TRICK)
