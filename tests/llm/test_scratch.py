import time

from cohortlift.llm.scratch import release, table


def test_released_shuffle_files_go(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    kept = table(spark.range(100_000).repartition(4, "id"), "released")
    assert shuffled() - before
    release(kept)
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
