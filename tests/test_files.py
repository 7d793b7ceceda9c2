import pytest

from quarterline.sources import files


class Session:
    """Stands in for sessions that a test can't start."""

    def __init__(self, master, conf):
        self.conf, self.sparkContext = self, self
        self.master, self.settings = master, conf

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_the_named_folder_wins():
    named = {"spark.checkpoint.dir": "hdfs://x/shared/"}
    assert files.shared_folder(Session("yarn", named)) == "hdfs://x/shared" == files.shared_folder(Session("local[4]", named))


def test_no_temporary_folder_on_a_cluster():
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]"):
        assert files.shared_folder(Session(master, {"spark.sql.warehouse.dir": "/wh"})) == "/wh/_scratch"


def test_a_warehouse_on_one_machine_is_no_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        files.shared_folder(Session("yarn", {"spark.sql.warehouse.dir": "file:/wh"}))
    assert files.shared_folder(Session("local-cluster[3,2,1024]", {"spark.sql.warehouse.dir": "file:/wh"})) == "file:/wh/_scratch"


def test_scratch_is_swept(spark):
    df = files.kept(spark.range(3), "numbers")
    assert df.count() == 3
    path = files._made[-1]
    files.sweep(spark)
    assert not files.exists(spark, path)


def test_one_of_many_writers_creates_a_file(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: files.write_text(spark, f"{tmp_path}/commit", str(k)), range(24)))
    assert sum(won) == 1 and files.read_text(spark, f"{tmp_path}/commit") == str(won.index(True))


def test_a_local_session_keeps_its_folder():
    session = Session("local[2]", {})
    assert files.shared_folder(session) == files.shared_folder(session)


def test_text_is_written_once(spark, tmp_path):
    path = f"{tmp_path}/a/b.json"
    assert files.write_text(spark, path, "ä") and not files.write_text(spark, path, "b")
    assert files.read_text(spark, path) == "ä" and files.names(spark, f"{tmp_path}/a")[-1] == "b.json"
    files.delete(spark, f"{tmp_path}/a")
    assert not files.exists(spark, path) and files.names(spark, f"{tmp_path}/a") == []


def test_text_is_written_once_without_links_too(spark, tmp_path, monkeypatch):
    def no_links(*_):
        raise PermissionError("no links here")

    monkeypatch.setattr(files.os, "link", no_links)
    assert files.write_text(spark, f"{tmp_path}/c", "a") and not files.write_text(spark, f"{tmp_path}/c", "b")
    assert files.read_text(spark, f"{tmp_path}/c") == "a" and [n for n in files.names(spark, f"{tmp_path}") if n.endswith(".part")] == []
