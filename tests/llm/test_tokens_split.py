"""Token counts of characters that Unicode versions class differently, and tasks without this library."""

import subprocess
import sys

import pyarrow as pa
import pytest
from fluxmill.llm import tokens
from pyspark import cloudpickle
from tokenizers import Tokenizer

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_newer_characters(spark):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    chars = [0x558, 0x58B, 0x88F, 0xA7CE, 0x10940, 0x323B0, 0x2FFFF, 0xE000, 0x85, 0xA0, 0x2028, 0x3000, 0x1C, 0x660, 0xBD, 0x2167]
    texts = [f"{chr(c)}{tail} x{chr(c)}1 {chr(c)}  {chr(c)}!{chr(c)}" for c in chars for tail in ("'s", "'ll", "'re", "", " ")]
    texts += [f"plain <|endoftext|>{chr(c)}'s<|endoftext|> end" for c in chars]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(table, PATH).collect()}
    special = Tokenizer.from_file(PATH)
    want = {i: len(special.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert got == want


def test_splits_are_those_of_the_library():
    splitter = tokens.Splitter(*tokens._plan(PATH))
    for low in range(0, 0x33000, 97):
        for c in (low, low + 1):
            if not 0xD800 <= c < 0xE000:
                text = f"it{chr(c)}'s {chr(c)}{chr(c)}9 \n{chr(c)}  {chr(c)}"
                assert splitter.pieces(text) == splitter._by_library(text), hex(c)


def test_tasks_run_without_this_library(tmp_path):
    """A bare Python process unpickles the functions of the tasks and runs them."""
    (tmp_path / "blocks").write_bytes(cloudpickle.dumps(tokens._blocks(PATH, 1_000)))
    (tmp_path / "pieces").write_bytes(cloudpickle.dumps(tokens._pieces(PATH)))
    docs = pa.record_batch([pa.array([1, 2]), pa.array(["a word, a word's", ""])], ["doc_id", "text"])
    words = pa.record_batch([pa.array([0, 0]), pa.array([0, 1]), pa.array([" word", "zzzzqqq"])], ["block", "place", "word"])
    for name, batch in (("docs", docs), ("words", words)):
        with pa.OSFile(str(tmp_path / name), "wb") as sink, pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
    code = """
import pickle, sys
import pyarrow as pa
def read(name):
    return iter(pa.ipc.open_stream(open(name, "rb").read()))
assert not [m for m in sys.modules if m.startswith("fluxmill")]
for task, name in (("blocks", "docs"), ("pieces", "words"), ("pieces", "words")):
    rows = list(pickle.load(open(task, "rb"))(read(name)))
    assert len(rows) == 1 and rows[0].num_rows == 1
assert "fluxmill" not in sys.modules
kept = vars(sys.modules["kept_tokenizers"])
assert len([k for k in kept if k.endswith("json")]) == 1
print("ran")
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert done.stdout == "ran\n", done.stderr
