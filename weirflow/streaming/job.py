"""The stream job as a program: ``spark-submit -m weirflow.streaming.job``, settings from the environment."""

from __future__ import annotations

from pyspark.sql import SparkSession

from weirflow.session import prepared, shared_folder
from weirflow.sources.streams import JobConfig
from weirflow.streaming.pipeline import run_topic


def main() -> None:
    config = JobConfig.from_env()
    spark = prepared(SparkSession.builder.appName("weirflow-stream").getOrCreate())
    run_topic(spark, config, f"{shared_folder(spark).rstrip('/')}/checkpoint-{config.topic}").awaitTermination()


if __name__ == "__main__":
    main()
