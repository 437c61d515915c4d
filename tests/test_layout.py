"""What may import what."""

from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_optional_parts_are_named_by_the_contract_alone():
    files = [*ROOT.glob("*.py"), *(p for p in (ROOT / "millrace").rglob("*.py") if "llm" not in p.parts), *(ROOT / "tests").glob("*.py")]
    naming = {p.name for p in files if any(word in p.read_text() for word in ("millrace.llm", "corpus_pipeline"))}
    assert naming <= {"__spark_entry__.py", "corpus_pipeline.py", "test_layout.py"}
