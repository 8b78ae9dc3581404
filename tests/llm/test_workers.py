"""Executors need no copy of the package: a session whose workers cannot import it."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_operators_run_where_workers_lack_the_package(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})            # of the driver alone
        from pyspark.sql import SparkSession, functions as F
        spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "4").getOrCreate())

        def known(batches):
            import importlib.util
            import pyarrow as pa
            for b in batches:
                yield pa.RecordBatch.from_pydict({{"there": [importlib.util.find_spec("gridpanel") is not None] * b.num_rows}})

        assert not spark.range(1).mapInArrow(known, "there boolean").first().there
        import __spark_entry__ as E
        for name, query in E.queries().items():
            if name[:2] == "op" and name[2].isdigit():
                print(name, query(spark, "/root/testdata/sf0.001").count(), flush=True)
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stdout + done.stderr[-3000:]
    assert len(done.stdout.split("\n")) > 13


def test_language_tasks_begin_without_what_other_operators_kept():
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    from gridpanel.llm import language
    from gridpanel.llm.common import per_worker

    class Docs:
        sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value)))
        schema = None

        def mapInArrow(self, task, schema):
            return task

    taps = {w: np.zeros((w, 256, language.FILTERS)) for w in language.WIDTHS}
    width = len(language.WIDTHS) * language.FILTERS
    net = language.ByteNetwork(["en"], taps, np.zeros(width), np.zeros((width, 1)), np.zeros(1))
    task = language.keep_identified(Docs(), net)
    per_worker(("encoder", "of another operator"), lambda: bytearray(1 << 20))
    out = task(iter([pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a word", None]})]))
    assert next(out).column("doc_id").to_pylist() == [1]
    assert "gridpanel_worker_values" not in sys.modules
    assert list(out) == []


def test_a_fresh_task_gives_back_what_allocators_hold():
    code = textwrap.dedent(f"""
        import re, sys
        sys.path.insert(0, {REPO!r})
        import pyarrow as pa
        from gridpanel.llm.common import fresh

        def held():
            return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

        before = held()
        many = [pa.array(["x" * 1000] * 100) for _ in range(1000)]
        assert held() > before + 80
        del many
        assert list(fresh(lambda batches: batches)(iter([1, 2]))) == [1, 2]
        assert held() < before + 40
    """)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=100)
    assert done.returncode == 0, done.stderr[-2000:]
