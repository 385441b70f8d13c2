"""The command line lists every registered key and prints a report."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_lists_keys():
    from pitchside.registry import QUERIES
    out = subprocess.run([sys.executable, "-m", "pitchside", "list"], cwd=ROOT, capture_output=True,
                         text=True, timeout=300, check=True).stdout.split()
    assert out == sorted(QUERIES)


def test_cli_show_prints_rows():
    out = subprocess.run([sys.executable, "-m", "pitchside", "show", "report_time_brackets",
                          "--sf", "/root/testdata/sf0.001", "--master", "local[2]"],
                         cwd=ROOT, capture_output=True, text=True, timeout=600, check=True).stdout
    assert "time_bracket" in out and "75+" in out
