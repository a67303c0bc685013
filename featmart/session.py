"""Session settings and configuration text."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Settings every job wants; a cluster's own submit configuration wins over them.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # State of streams lies beside the heap, so that many keys do not end an executor.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "featmart", master: str | None = None, conf: Mapping[str, str] | None = None) -> SparkSession:
    """Build or reuse a session; `${VAR}` in a value is taken from the environment."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, substitute(str(value)))
    return builder.getOrCreate()


def substitute(text: str, env: Mapping[str, str] | None = None) -> str:
    """Replace every `${NAME}` by the environment's value, or by nothing when it is unset."""
    env = os.environ if env is None else env
    return re.sub(r"\$\{(\w+)\}", lambda m: env.get(m.group(1), ""), text)
