"""A key holding a third of all rows never reaches one task whole.

Runs in its own Spark process (the event log has to be on from the start) on
events derived from the test table; see ``skew/run_skewed.py``.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

HERE = os.path.dirname(os.path.abspath(__file__))


def test_hot_key_is_split_or_combined_before_the_shuffle():
    scratch = tempfile.mkdtemp(prefix="tessera-skew-")
    out = subprocess.run(
        [sys.executable, os.path.join(HERE, "skew", "run_skewed.py"), "/root/testdata/sf0.01", scratch],
        capture_output=True, text=True, timeout=600, check=True,
    )
    result = json.loads(out.stdout.strip().splitlines()[-1])
    hot, largest = result["hot_rows"], result["largest_task_read"]
    assert hot * 3 >= result["rows"] * 0.9  # about a third of all rows
    # the plain window really puts the whole hot key into one task ...
    assert largest["row_number_window"] >= hot
    # ... the skew path cuts it into pieces over many tasks
    assert largest["row_number_pieces"] < hot / 2
    # partial top-1 / partial aggregation: at most one row per key per map task
    for name in ("silver", "top_n_other", "value_frequencies", "profile", "reconciliation"):
        assert largest[name] < hot / 10, (name, largest)
