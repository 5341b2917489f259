"""Functions of tasks reach executors that have no copy of the package."""

import pickle
import subprocess
import sys

from pyspark import cloudpickle

from litsieve.llm import queries

FOLDER = "/root/testdata/sf0.001"
# Broadcast values are checked apart.
LOAD = "import pickle, sys, pyspark.core.broadcast as b\nb._from_id = lambda *a: None\nfor data in pickle.load(sys.stdin.buffer):\n    pickle.loads(data)\nassert not any(m.startswith('litsieve.') for m in sys.modules)"


def test_functions_load_without_the_package(spark, monkeypatch, tmp_path):
    kind, functions = type(spark.range(0)), []
    original = kind.mapInArrow

    def recorded(self, func, *args, **kwargs):
        functions.append(cloudpickle.dumps(func))
        return original(self, func, *args, **kwargs)

    monkeypatch.setattr(kind, "mapInArrow", recorded)
    send = spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: functions.append(pickle.dumps(value)) or send(value))
    for name in ("op5_minmax_dedup", "op7_licences", "op8_toxicity", "op9_best_fit_packing", "op11_token_windows", "op12_slot_negatives", "op13_suffix_dedup"):
        queries.queries()[name](spark, FOLDER)
    assert len(functions) > 15
    done = subprocess.run([sys.executable, "-I", "-c", LOAD], input=pickle.dumps(functions), cwd=tmp_path, capture_output=True)
    assert done.returncode == 0, done.stderr.decode()


def test_workers_return_memory_after_the_last_batch():
    from litsieve.llm import common

    done = []
    wrapped = common.memory_returned(lambda batches: (x + 1 for x in batches))
    assert list(wrapped(iter([1, 2]))) == [2, 3]
    common.worker_value("first", lambda: done.append(1) or "a")
    assert common.worker_value("second", lambda: "b") == "b"
    # The larger value of another operator has made room and is made again.
    assert common.worker_value("first", lambda: "again") == "again" and done == [1]
