import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_results_survive_task_failures():
    """Separate JVM (local[4,3]: up to 3 attempts per task) with injected failures."""
    out = subprocess.run(
        [sys.executable, os.path.join(HERE, "fault_job.py"), "/root/testdata/sf0.001"],
        capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0, out.stderr[-3000:]
    assert out.stdout.strip().endswith("OK")
