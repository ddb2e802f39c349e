import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_python_functions_run_without_the_package_on_the_executors(tmp_path):
    """The driver knows the package; the workers start in another folder and do not."""
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        import __spark_entry__ as entry
        from folioscope.session import local_session
        spark = local_session("elsewhere", 2, 2)
        for name in ("page_links", "match_scheme"):
            assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
