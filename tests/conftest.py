import pytest

from tabloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def shuffled(monkeypatch):
    """Every size bound at zero: no lookup is broadcast, no group is ranked in one window."""
    from tabloom import ordering

    monkeypatch.setattr(ordering, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(ordering, "WINDOW_ROWS", 0)
