"""Executors have no copy of the package: the operators' objects travel."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_workers_without_the_package(tmp_path):
    script = tmp_path / "driver.py"
    script.write_text(textwrap.dedent(f"""
        import os, sys
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {str(tmp_path / "ckpt")!r}).getOrCreate()

        def absent(batches):
            import importlib.util
            assert importlib.util.find_spec("islet") is None
            yield from batches

        spark.range(4).mapInArrow(absent, "id long").collect()
        sys.path.insert(0, {REPO!r})  # the driver's alone: workers keep the environment of their start
        from islet.llm import cascade, decontaminate, langid
        docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven", "en"), (2, "мир да любовь", "ru")], "doc_id long, text string, lang string")
        items = docs.select(docs.doc_id.alias("item_id"), "text").filter("item_id = 1")
        assert sorted((r.row.doc_id, r.n_hit) for r in decontaminate.find(docs.select("doc_id", "text"), items).collect()) == [(1, 11), (2, 0)]
        got = langid.label(docs, langid.fit(docs.select("text", "lang"))).collect()
        assert sorted((r.row.doc_id, r.lang_pred) for r in got) == [(1, "en"), (2, "ru")]
        urls = spark.createDataFrame([("http://a.com/x",), ("http://example.com/en/y",)], "url string")
        rules = [("allow", "com", "/"), ("block", "example.com", "/en/")]
        assert sorted(r.verdict for r in cascade.judge(urls, rules).collect()) == ["allow", "block"]
        print("whole")
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "whole" in out.stdout, out.stderr[-3000:]
