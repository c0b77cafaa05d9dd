"""Kernels run where this package is not installed."""

import os
import subprocess
import sys

from pyspark import cloudpickle

from slantwise.llm import bwt, conversations, kernels, lattice, pairs, simhash


def test_kernels_load_without_the_package(tmp_path):
    sent = [conversations._solve, conversations._chain, conversations._hashed, lattice.ops_rows, kernels.distinct_rows, pairs.join_lists]
    sent += [simhash.neighbours, lambda b: simhash.linked(b, 4, 9), lambda b: simhash.points(b, 4), lambda b: bwt.run_rows(kernels.distinct_rows(b), 9, 4)]
    (tmp_path / "sent").write_bytes(cloudpickle.dumps(sent))
    code = (
        "import pickle, pyarrow as pa; f = pickle.load(open('sent', 'rb'));"
        "b = pa.RecordBatch.from_arrays([pa.array(['=1']), pa.array([0]), pa.array([1]), pa.array(['ua']), pa.array(['ua'])], list('abcde'));"
        "print(len(f), next(f[0](iter([b]))).to_pylist()[0]['table'][0]['audit'])"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert out.stdout.split() == [str(len(sent)), "KK"], out.stderr[-2000:]
