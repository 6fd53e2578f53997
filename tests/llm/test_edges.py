"""Odd rows that other tests leave out: chat, urls, tokens, and the whole pipeline on hostile tables."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tenderline.llm.bpe import token_digests
from tenderline.llm.chat import format_turns, read_back, text_parts
from tenderline.llm.urls import judged

CHAT = "conv_id long, turn long, role string, text string, piece string, at long, nth long, head int, flat string, n long"


def read(spark, rows):
    turns = spark.createDataFrame([(*r, "p", 1, 2, 3, "f", 4) for r in rows], CHAT)
    return {r["conv_id"]: r for r in read_back(format_turns(turns.withColumn("parts", text_parts(F.col("text"))))).collect()}


def test_chat_of_many_turns_repeated_rows_and_clashing_columns(spark):
    long = [(1, k, "assistant" if k % 2 else "user", f"<|im_end|>{k}" * (k % 5)) for k in range(3000)]
    found = read(spark, [*long, (2, 0, "user", "same"), (2, 0, "user", "same"), (3, 0, "assistant", "x" * 200_000), (4, None, None, None)])
    told = "".join(f"{role}\n{text}\n" for _, _, role, text in long)
    loss = "".join(text for _, _, role, text in long if role == "assistant")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    one = found[1]
    assert (one["n_turns"], one["turns_sha256"], one["loss_chars"], one["loss_sha256"]) == (3000, sha(told), len(loss), sha(loss))
    assert (found[2]["n_turns"], found[2]["turns_sha256"]) == (2, sha("user\nsame\n" * 2))
    assert found[3]["loss_chars"] == 200_000 and found[4]["turns_sha256"] == sha("\n\n")


def test_urls_of_any_length_and_clashing_columns(spark):
    schema = "page_id long, url string, host string, path string, rule string, ruled string, score double, ratio double, verdict string"
    urls = [f"h://x.org/{k}" for k in range(30)] + [f"h://a.example.org/es/{k}" for k in range(30)]
    urls += ["h://new.net/" + "q" * 50_000, None, "", "h://", "h://?", "H://Ä.net/x#y"]
    rows = [(k, u, "a", "b", "c", "d", 1.0, 2.0, "e") for k, u in enumerate(urls)]
    found = {r["page_id"]: r for r in judged(spark.createDataFrame(rows, schema)).collect()}
    assert len(found) == len(rows)
    assert all(found[k]["verdict"] == ("allow" if k < 30 else "block") for k in range(60))
    assert found[60]["host"] == "new.net" and len(found[60]["path"]) == 50_001 and found[60]["verdict"] in ("allow", "block")
    assert [(found[k]["host"], found[k]["path"]) for k in (61, 62, 63, 64)] == [("", "")] * 4
    assert (found[65]["host"], found[65]["path"]) == ("Ä.net", "/x")
    assert judged(spark.createDataFrame([], schema)).count() == 0


def test_tokens_of_an_empty_table(docs):
    assert token_digests(docs([]), public_tokenizers.path("word_bpe_49k.json")).count() == 0


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, own string, sha string, bits string, row_key long, score double"


@pytest.mark.parametrize("empty", ["", "documents", "benchmark", "labels"])
def test_pipeline_on_hostile_tables(spark, tmp_path, empty):
    leak = " ".join(f"b{k}" for k in range(20))
    texts = [None, "", "  ", "one two", "one  two", "one two three four five six", leak, f"start {leak} end", "w " * 40_000, None]
    rows = [(k, t, None, "s", None, "o", "h", "b", 5, 0.5) for k, t in enumerate(texts)]
    rows += [(None, "no id here at all today", None, None, None, None, None, None, None, None)]
    tables = {
        "documents": spark.createDataFrame([] if empty == "documents" else rows, DOCUMENTS),
        "benchmark": spark.createDataFrame([] if empty == "benchmark" else [(1, leak), (2, None), (None, "")], "item_id long, text string"),
        "labels": spark.createDataFrame([] if empty == "labels" else [(3, 1, 0), (5, 0, 0), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int"),
    }
    for name, table in tables.items():
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    want = {0, 2, 3, 5, 8, None} | ({6} if empty == "benchmark" else set())
    assert set(found) == (set() if empty == "documents" else want)
    if found:
        assert found[0]["n_tokens"] == 0 and found[0]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
        assert found[8]["n_tokens"] == 40_000
