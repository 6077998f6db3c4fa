"""Chat formatting: what is written is read back, whatever the texts hold."""

import hashlib
import random
from itertools import groupby

from hypothesis import given, settings, strategies as st

from regtables.llm import chat_format as chat


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    found = []
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, turns in groupby(sorted(rows, key=key), key=lambda r: r[0]):
        turns = [(r or "", t or "") for _, _, r, t in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        found.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)))
    return sorted(found, key=repr)


NASTY = ["<|end|>", "<", "<|", "|>", "\\", "<\\|", "<\\\\|also|>", "</s>[INST] ok [/INST]", "", "😀é", "\n", "$1\\1", "<|role|>assistant<|text|>"]


def cases():
    rng = random.Random(6)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", None, "a<|b", ""]), "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 5)))))
    rows += [(70, 0, "assistant", None), (71, None, "user", "x"), (None, 1, "user", "y"), (None, 0, "assistant", "z"), rows[0], (72, 5, "user", "b"), (72, 5, "assistant", "a"), (73, 0, "assistant", "long " * 200_000)]
    return rows


def test_against_brute_force(spark):
    rows = cases()
    d = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int").repartition(5)
    made = chat.formatted(d)
    got = chat.digests(made).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows)
    texts = {r.conv_id: r.formatted for r in made.collect()}
    assert all(r.formatted_chars == len(texts[r.conv_id]) for r in got)


def test_neighbours_of_one_role_are_merged(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "user", "d")]
    made = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert made.formatted == "<|role|>user<|text|>a<|also|>b<|end|><|role|>assistant<|text|>c<|end|><|role|>user<|text|>d<|end|>"
    assert [made.formatted[s.start : s.start + s.length] for s in made.loss] == ["c"]


def test_no_python_in_the_plan_and_empty_table(spark):
    d = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    made = chat.digests(chat.formatted(d))
    assert made.collect() == []
    assert "Python" not in made._jdf.queryExecution().toString() and "Arrow" not in made._jdf.queryExecution().toString()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="<|\\>a", max_size=12), min_size=1, max_size=8))
def test_escaping_is_reversible(spark, texts):
    from pyspark.sql import functions as F

    d = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in d.select("t", "e", chat.unescaped(F.col("e")).alias("back")).collect():
        assert r.back == r.t and "<|" not in r.e
