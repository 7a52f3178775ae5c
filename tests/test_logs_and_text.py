"""Run-log readers (S06-S08), SFT records (M05), intervals (M06), schedule
(C13), special tokens (J04), prompt sections (P09), chat tool turns (P08)."""

import json

import pytest
from pyspark.sql import functions as F

from rewardframe.functions.chat import render, section
from rewardframe.sources import logs as LG


def test_trainer_state_superset_schema(spark, tmp_path):
    doc = {"global_step": 30, "epoch": 1.0, "log_history": [
        {"loss": 3.1, "grad_norm": 1.2, "learning_rate": 2e-5, "entropy": 2.9, "num_tokens": 100.0,
         "mean_token_accuracy": 0.4, "epoch": 0.3, "step": 10},
        {"loss": 3.0, "grad_norm": 1.1, "learning_rate": 1e-5, "entropy": 2.8, "num_tokens": 250.0,
         "mean_token_accuracy": 0.45, "epoch": 0.6, "step": 20},
        {"train_runtime": 12.5, "train_loss": 3.05, "epoch": 1.0, "step": 30, "total_flos": 1e10},
    ]}
    p = tmp_path / "trainer_state.json"
    p.write_text(json.dumps(doc, indent=2))
    h = LG.read_trainer_state(spark, str(p))
    rows = h.orderBy("record_no").collect()
    assert len(rows) == 3 and rows[2].loss is None and rows[2].train_runtime == 12.5
    rec = LG.sft_records(h).orderBy("step").collect()
    assert [r.interval_tokens for r in rec] == [100.0, 150.0]


def test_console_log_noise_dropped(spark, tmp_path):
    p = tmp_path / "output.log"
    p.write_text(
        "  0%|          | 0/8 [00:00<?, ?it/s]\nsome warning text\n"
        "{'loss': 1.25, 'grad_norm': 0.5, 'learning_rate': 4e-05, 'entropy': 0.75, 'num_tokens': 4096.0, "
        "'mean_token_accuracy': 0.625, 'epoch': 0.5}\n"
        "100%|#####| 8/8 [00:16<00:00,  2.00s/it]\n"
        "{'train_runtime': 16.0, 'train_samples_per_second': 32.5, 'train_steps_per_second': 0.5, "
        "'train_loss': 1.125, 'epoch': 1.0}\n"
    )
    df = LG.read_console_log(spark, str(p))
    rows = df.collect()
    assert len(rows) == 2
    assert rows[0].loss == 1.25 and rows[1].train_samples_per_second == 32.5


def test_summary_flatten(spark, tmp_path):
    p = tmp_path / "summary.json"
    p.write_text(json.dumps({"_step": 6, "_logger": {"runtime": 169}, "train/loss": 3.02, "nested": {"a": {"b": 1}}}))
    df = LG.read_summary(spark, str(p))
    assert set(df.columns) >= {"_logger.runtime", "train/loss", "nested.a.b"}
    assert df.first()["_logger.runtime"] == 169


def test_interval_and_schedule(spark):
    assert LG.interval_steps(0.1, 63) == 7 and LG.interval_steps(10, 63) == 10
    df = spark.createDataFrame([(10,), (20,), (60,)], "s int")
    got = [r.lr for r in df.select(LG.linear_lr(F.col("s"), 2e-5, 63).alias("lr")).collect()]
    assert got == pytest.approx([1.714286e-5, 1.396825e-5, 1.269841e-6], rel=1e-6)


def test_special_tokens_join(spark):
    assert len(LG.SPECIAL_TOKENS) == 22
    df = spark.createDataFrame([(LG.EOS_ID,), (LG.PAD_ID,), (42,)], "token_id long")
    out = {r.token_id: r.special_token for r in LG.label_special(df, "token_id").collect()}
    assert out == {LG.EOS_ID: "<|im_end|>", LG.PAD_ID: "<|endoftext|>", 42: None}


def test_sections(spark):
    text = "SUBREDDIT: r/relationships\n\nTITLE: A title here\n\nPOST: Body line one.\nline two\n\nTL;DR:"
    df = spark.createDataFrame([(text,)], "p string")
    r = df.select(*[section(F.col("p"), n).alias(n) for n in ("SUBREDDIT", "TITLE", "POST")]).first()
    assert r.SUBREDDIT == "r/relationships" and r.TITLE == "A title here" and r.POST == "Body line one.\nline two"


def test_chat_render_tool_turns(spark):
    msgs = [("user", "hi"), ("assistant", "calling"), ("tool", "r1"), ("tool", "r2"), ("assistant", "done")]
    df = spark.createDataFrame([( [ {"role": r, "text": t} for r, t in msgs ],)], "msgs array<struct<role:string,text:string>>")
    out = df.select(render(F.col("msgs"), add_generation_prompt=True).alias("s")).first().s
    expect = (
        "<|im_start|>system\nYou are Qwen, created by Alibaba Cloud. You are a helpful assistant.<|im_end|>\n"
        "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\ncalling<|im_end|>\n"
        "<|im_start|>user\n<tool_response>\nr1\n</tool_response>\n<tool_response>\nr2\n</tool_response><|im_end|>\n"
        "<|im_start|>assistant\ndone<|im_end|>\n<|im_start|>assistant\n"
    )
    assert out == expect
    sys_first = spark.createDataFrame([([{"role": "system", "text": "S"}, {"role": "user", "text": "u"}],)],
                                      "msgs array<struct<role:string,text:string>>")
    assert sys_first.select(render(F.col("msgs")).alias("s")).first().s == (
        "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nu<|im_end|>\n"
    )


def test_map_and_filter_rows(spark):
    from rewardframe.operators.rowmap import filter_rows, map_rows

    df = spark.range(100).selectExpr("id", "cast(id as string) as s")
    m = map_rows(df, lambda b: b.assign(n=b["s"].str.len()), "id long, s string, n long")
    assert m.where("n = 2").count() == 90
    f = filter_rows(df, lambda b: b["id"] % 3 == 0)
    assert f.count() == 34 and f.columns == ["id", "s"]


def test_chat_render_tool_calls_and_tools_header(spark):
    schema = ("msgs array<struct<role:string,text:string,tool_calls:array<struct<name:string,arguments:string>>>>, "
              "tools array<string>")
    msgs = [
        {"role": "user", "text": "weather?", "tool_calls": None},
        {"role": "assistant", "text": "", "tool_calls": [{"name": "get", "arguments": '{"city": "Paris"}'}]},
        {"role": "tool", "text": "sunny", "tool_calls": None},
    ]
    df = spark.createDataFrame([(msgs, ['{"name": "get"}'])], schema)
    out = df.select(render(F.col("msgs"), tools=F.col("tools"), tool_calls=True).alias("s")).first().s
    expect = (
        "<|im_start|>system\nYou are Qwen, created by Alibaba Cloud. You are a helpful assistant."
        "\n\n# Tools\n\nYou may call one or more functions to assist with the user query.\n\n"
        "You are provided with function signatures within <tools></tools> XML tags:\n<tools>"
        '\n{"name": "get"}'
        "\n</tools>\n\nFor each function call, return a json object with function name and arguments within "
        '<tool_call></tool_call> XML tags:\n<tool_call>\n{"name": <function-name>, "arguments": <args-json-object>}\n'
        "</tool_call><|im_end|>\n"
        "<|im_start|>user\nweather?<|im_end|>\n"
        '<|im_start|>assistant\n<tool_call>\n{"name": "get", "arguments": {"city": "Paris"}}\n</tool_call><|im_end|>\n'
        "<|im_start|>user\n<tool_response>\nsunny\n</tool_response><|im_end|>\n"
    )
    assert out == expect
