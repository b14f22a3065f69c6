"""Triplet files arriving over time, appended exactly once and folded into a matrix."""

import os

import numpy as np

from tilealg.streaming import (append_cells_log, load_cells_log, load_vector_log,
                               read_text_stream, read_text_vector_stream)


def _drop(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_stream_accumulates_updates(spark, tmpdir_path):
    inbox = os.path.join(tmpdir_path, "inbox")
    log = os.path.join(tmpdir_path, "log")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    _drop(inbox, "a.txt", "0,0,1\n0,1,5\n1,1,2\n")
    q = append_cells_log(read_text_stream(spark, inbox), log, ckpt)
    q.awaitTermination()
    m = load_cells_log(spark, log, (2, 2), (1, 2)).to_numpy()
    assert m.tolist() == [[1, 5], [0, 2]]
    # a second file and a restart from the same checkpoint: only new data is added
    _drop(inbox, "b.txt", "0,0,10\nbad line\n1,0,3\n")
    q = append_cells_log(read_text_stream(spark, inbox), log, ckpt)
    q.awaitTermination()
    m = load_cells_log(spark, log, (2, 2), (1, 2)).to_numpy()
    assert np.array_equal(m, [[11, 5], [3, 2]])


def test_vector_stream(spark, tmpdir_path):
    inbox = os.path.join(tmpdir_path, "vin")
    log = os.path.join(tmpdir_path, "vlog")
    _drop(inbox, "a.txt", "0,1\n2,3\n0,4\n")
    append_cells_log(read_text_vector_stream(spark, inbox), log).awaitTermination()
    assert load_vector_log(spark, log, 3, 2).to_numpy().tolist() == [5, 0, 3]
