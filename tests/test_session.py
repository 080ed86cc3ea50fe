import pytest

from kithwork import session


class Settings:
    def __init__(self, master, named=None):
        self.named, self.sparkContext, self.conf = named, self, self
        self.master, self.applicationId = master, "app"

    def get(self, name, default):
        return self.named or default


def test_folder_comes_from_the_session():
    assert session.shared_folder(Settings("yarn", "hdfs://shared/cp")) == "hdfs://shared/cp"


def test_own_folder_only_for_a_local_session():
    own = session.shared_folder(Settings("local[2]"))
    assert session.shared_folder(Settings("local[2]")) == own
    with pytest.raises(RuntimeError):
        session.shared_folder(Settings("yarn"))
