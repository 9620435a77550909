from learnsilver import session


class FakeConf:
    def __init__(self, **settings):
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key.replace(".", "_"), default)


def fake(**settings):
    return type("Session", (), {"conf": FakeConf(**settings)})


WAREHOUSE = {"spark_sql_warehouse_dir": "s3a://lake/warehouse/"}


def test_the_named_folder_is_used():
    spark = fake(spark_checkpoint_dir="s3a://lake/tmp/", **WAREHOUSE)
    assert session.shared_folder(spark) == "s3a://lake/tmp"


def test_without_one_it_is_in_the_warehouse():
    assert session.shared_folder(fake(**WAREHOUSE)) == "s3a://lake/warehouse/_scratch"


def test_scratch_paths_are_never_shared():
    spark = fake(spark_checkpoint_dir="/shared")
    one, two = session.scratch_path(spark, "raw"), session.scratch_path(spark, "raw")
    assert one != two and one.startswith("/shared/raw-")
