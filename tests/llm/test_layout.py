"""The rest of the library does without the corpus operators."""
import pathlib
import re
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[2]


def test_nothing_else_imports_them():
    for f in (ROOT / "scorecraft").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            assert not re.search(r"scorecraft\.llm|from \.+llm|corpus_pipeline", f.read_text(encoding="utf8")), f


def test_entry_works_without_them(tmp_path):
    code = ("import sys; sys.modules['scorecraft.llm'] = None; import __spark_entry__ as e; "
            "q = e.queries(); assert len(q) > 100 and not [k for k in q if k.startswith('op')] and 'pipeline' not in q; e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_native_operators_use_no_python_workers():
    for name in ("exact_dedup", "mixing", "url_filter", "components"):
        text = (ROOT / "scorecraft/llm" / f"{name}.py").read_text(encoding="utf8")
        assert not re.search(r"mapIn|applyIn|udf|\.rdd|toPandas", text), name
