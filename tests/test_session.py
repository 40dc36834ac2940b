"""Session configuration: semantic settings always applied, sizing only where unset."""

from martforge.session import CLUSTER, SEMANTIC, checkpoint_dir, configure


def test_configure_forces_semantics_and_keeps_launcher_sizing(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "true")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        configure(spark, scale="cluster")
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == "false"
        assert spark.conf.get("spark.sql.ansi.enabled") == "true"
        assert spark.conf.get("spark.sql.shuffle.partitions") == before  # set by the launcher: kept
        assert set(SEMANTIC) <= {"spark.sql.ansi.enabled", "spark.sql.session.timeZone",
                                 "spark.sql.csv.parser.columnPruning.enabled"}
        assert "spark.sql.adaptive.advisoryPartitionSizeInBytes" in CLUSTER
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_checkpoint_folder_is_the_sessions(spark):
    path = checkpoint_dir(spark)
    assert path and path == spark.sparkContext.getCheckpointDir()
