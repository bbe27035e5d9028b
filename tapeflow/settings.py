"""Job settings from the environment; a blank variable counts as unset."""

import os
from collections.abc import Mapping
from dataclasses import dataclass

from . import constants as C


@dataclass(frozen=True)
class Settings:
    app_name: str = "clean-trades-streaming"
    spark_master: str | None = None  # that of spark-submit
    bootstrap_servers: str = "localhost:9092"
    topic: str = C.CLEAN_TOPIC
    starting_offsets: str = "latest"
    watermark: str = C.WATERMARK
    sink: str = "console"
    output_dir: str = "./data/spark_out"
    checkpoint_dir: str = "./data/checkpoints"

    def output_path(self, table: str) -> str:
        return f"{self.output_dir.rstrip('/')}/{table}"

    def checkpoint_path(self, table: str) -> str:
        return f"{self.checkpoint_dir.rstrip('/')}/{table}"


# The environment variable that sets each field.
ENVIRONMENT = {
    "app_name": "SPARK_APP_NAME",
    "spark_master": "SPARK_MASTER",
    "bootstrap_servers": "KAFKA_BOOTSTRAP_SERVERS",
    "topic": "KAFKA_TOPIC",
    "starting_offsets": "KAFKA_STARTING_OFFSETS",
    "watermark": "WATERMARK",
    "sink": "SINK",
    "output_dir": "OUTPUT_DIR",
    "checkpoint_dir": "CHECKPOINT_DIR",
}


def load_settings(env: Mapping[str, str] | None = None) -> Settings:
    env = os.environ if env is None else env
    given = {field: env.get(name, "").strip() for field, name in ENVIRONMENT.items()}
    given = {field: text for field, text in given.items() if text}
    if "sink" in given:
        given["sink"] = given["sink"].lower()
    for field in ("output_dir", "checkpoint_dir"):
        path = given.get(field, getattr(Settings, field))
        # A URI (hdfs://, s3a://, ...) stays as it is.
        given[field] = path if "://" in path else os.path.abspath(path)
    return Settings(**given)
