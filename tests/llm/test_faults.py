import os
import subprocess
import sys


def test_results_survive_failing_tasks(tmp_path):
    job = os.path.join(os.path.dirname(os.path.abspath(__file__)), "llm_fault_job.py")
    out = subprocess.run([sys.executable, job, str(tmp_path)], capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    results = [line.split()[1:] for line in out.stdout.splitlines() if line.startswith("RESULT")]
    assert len(results) == 7 and all(same == "True" and int(rows) == 200 for _, rows, same in results), results
