import pytest

from playbill import SUITE
from playbill import __main__ as command


def test_a_failing_query_does_not_end_the_suite(spark, tmp_path, monkeypatch, capsys):
    broken = list(SUITE)[1]

    def answer(session, name):
        if name == broken:
            raise ValueError("no such column")
        return session.range(3)

    monkeypatch.setattr(command, "run_query", answer)
    command.run_suite(spark, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir()} == set(SUITE) - {broken}
    assert f"{broken} failed: no such column" in capsys.readouterr().err


def test_a_suite_without_any_success_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(command, "run_query", lambda session, name: 1 / 0)
    with pytest.raises(SystemExit) as ended:
        command.run_suite(spark, str(tmp_path))
    assert ended.value.code == 1
