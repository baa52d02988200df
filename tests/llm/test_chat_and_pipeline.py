"""Chat formatting, and the pipeline stage by stage."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lateparcel.llm import chat_format, ngram_join, queries
from tests.llm.helpers import documents
from tests.llm.test_pairs import near_copies

NASTY = [
    "</s>[INST] ok [/INST]", "\\", "<\\s>", "\\\\</s>", "<</s>", "[[INST]", "<|im_end|>", "<", "a<", "[ROLE]x[INST]",
    "", None, "line\n\nline", "é🙂", "$1 \\1",
]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(spark, turns):
    """turns: (conv_id, turn, role, text). Digests must be those of the plain turns."""
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = chat_format.digests(chat_format.format_turns(chat_format.to_turns(frame))).collect()
    want = {}
    for conv, turn, role, text in turns:
        want.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert {r["conv_id"] for r in rows} == set(want)
    for r in rows:
        own = sorted(want[r["conv_id"]], key=lambda x: (x[0], x[1].encode(), x[2].encode()))
        loss = "".join(t for _, role, t in own if role == "assistant")
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == digest("".join(f"{role}\n{t}\n" for _, role, t in own))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), digest(loss))


def test_reading_back_control_strings(spark):
    turns = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(NASTY)]
    turns += [(2, i, t, "x") for i, t in enumerate(NASTY)]  # as roles
    turns += [(3, None, "user", "a"), (3, 0, "assistant", "b"), (3, 0, "assistant", "b"), (None, 0, None, None)]
    check(spark, turns)


def test_format_is_sql_only(spark, small_folder):
    frame = queries.op4_chat_format(spark, small_folder)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


LAYOUT_ROWS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "input": "it", "output": "done"}, [("user", "do\n\nit"), ("assistant", "done")]),
    ({"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "completion": "c", "extra": 3}, [("user", "p"), ("assistant", "c")]),
    ({"system": "s", "prompt": "p", "response": None}, [("system", "s"), ("user", "p"), ("assistant", "")]),
    ({"question": "p", "answer": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"other": 1}, []),
]


def test_json_records_of_many_layouts(spark):
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(LAYOUT_ROWS)] + [(99, None), (98, "no json")]
    frame = spark.createDataFrame(rows, "conv_id long, record string")
    got = {}
    for r in chat_format.from_json(frame).orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for i, (_, turns) in enumerate(LAYOUT_ROWS):
        assert got.get(i, []) == turns
    assert {r["conv_id"] for r in chat_format.unknown_json(frame).collect()} == {7, 98, 99}


def test_json_of_mixed_and_partial_layouts(spark):
    """The first complete layout is taken; optional fields may be missing."""
    turns = [("user", "q"), ("assistant", "a")]
    said = [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]
    cases = [
        ({"messages": said, "prompt": "x"}, turns),
        ({"instruction": "q", "output": "a"}, turns),
        ({"instruction": "q", "response": "a"}, turns),
        ({"prompt": "q", "response": "a"}, turns),
        ({"messages": [{"role": "user"}, *said]}, [("user", ""), *turns]),
        ({"instruction": "q"}, []),
    ]
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(cases)]
    frame = spark.createDataFrame(rows, "conv_id long, record string")
    got = {}
    for r in chat_format.from_json(frame).orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {i: turns for i, (_, turns) in enumerate(cases) if turns}
    assert [r["conv_id"] for r in chat_format.unknown_json(frame).collect()] == [5]


@pytest.mark.parametrize("i", range(7))
def test_tables_of_many_layouts(spark, i):
    record, turns = LAYOUT_ROWS[i]
    if record.get("response", "") is None:
        record = {**record, "response": ""}
    frame = spark.createDataFrame([{"conv_id": 5, "odd": 1, **record}])
    if "messages" in record or "conversations" in record:
        name = "messages" if "messages" in record else "conversations"
        keys = list(record[name][0])
        kind = f"array<struct<{','.join(f'`{k}`:string' for k in keys)}>>"
        frame = frame.withColumn(name, F.from_json(F.to_json(name), kind))
    got = [(r["role"], r["text"]) for r in chat_format.to_turns(frame).orderBy("turn").collect()]
    assert got == turns


def test_unknown_table_names_its_fields(spark):
    with pytest.raises(ValueError, match="strange"):
        chat_format.to_turns(spark.createDataFrame([(1, 2)], "conv_id long, strange long"))


def test_empty_conversations(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digests(chat_format.format_turns(chat_format.to_turns(frame))).count() == 0


# --- pipeline


def test_stages_and_their_columns(spark, small_folder, tmp_path):
    """Every stage works on what its predecessor kept; decisions take effect."""
    docs = spark.read.parquet(f"{small_folder}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    classes = None
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small_folder)
        if number == 2:
            classes = {r["class_id"] for r in ngram_join.join(docs).collect()}
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= ids
        if number == 2:
            assert now == classes
        if number in (3, 4):
            assert now == ids
        ids = now
    assert len(corpus_pipeline.STAGES) == 5
    found = corpus_pipeline.run(spark, small_folder)
    assert sorted(map(tuple, found.drop("sequence_id", "offset").collect())) == sorted(
        map(tuple, docs.drop("sequence_id", "offset").collect())
    )


def test_one_of_each_near_copy_stays(spark):
    import random

    texts = near_copies(random.Random(9), 6, 9)
    docs = documents(spark, texts)
    kept = corpus_pipeline.deduplicated(spark, docs, "")
    assert kept.columns == docs.columns
    rows = ngram_join.join(docs).collect()
    assert {r["doc_id"] for r in kept.collect()} == {r["class_id"] for r in rows}
