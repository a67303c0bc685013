"""Feature definitions of the malware data set."""

from __future__ import annotations

from pyspark.sql import types as T

from ..operators.features import ACTIVITY_COLUMNS, NETWORK_COLUMNS, PERMISSION_COLUMNS, with_on_demand_scores
from .registry import Entity, FeatureView, OnDemandView, Registry

# Entities, view names, field names and types of the published feature contract.
TARGET_FIELDS = {"malware": T.LongType(), "mal_family": T.StringType(), "data_source": T.StringType(), "dataset_split": T.StringType()}
SYSCALL_FIELDS = (
    "read", "write", "open", "close", "clone", "socket", "connect", "sendto", "recvfrom", "mmap2", "mprotect", "ioctl", "futex",
    "kill", "bind",
)
TOTAL_FIELDS = {
    "nr_syscalls": T.LongType(), "nr_permissions": T.LongType(), "activities": T.DoubleType(), "detection_ratio": T.DoubleType(),
}
PERMISSION_FIELDS = (
    "internet", "read_external_storage", "write_external_storage", "read_phone_state", "access_network_state", "wake_lock",
    "receive_boot_completed", "camera", "record_audio", "send_sms",
)
ENTITIES = (
    Entity("user", ("user_id",)),
    Entity("device", ("device_id",)),
    Entity("malware_sample", ("sample_id",), description="One application package"),
    Entity("malware_family", ("mal_family",), description="One malware family"),
    Entity("family_statistics", ("family_id",), description="One row of the family dimension"),
)
SAMPLE_TTL = "365 days"
SCORE_FIELDS = {
    "syscall_activity_score": T.DoubleType(), "is_high_syscall_activity": T.LongType(), "network_activity_score": T.DoubleType(),
    "permission_risk_score": T.DoubleType(),
}
FAMILY_FIELDS = {
    "family_name": T.StringType(), "is_malware_family": T.BooleanType(), "total_samples": T.LongType(), "unique_samples": T.LongType(),
    "emulator_count": T.LongType(), "real_device_count": T.LongType(), "earliest_year": T.IntegerType(), "latest_year": T.IntegerType(),
    "year_span": T.IntegerType(),
}


def on_demand_scores(view: FeatureView) -> OnDemandView:
    """The derived scores over those of their columns that a view has."""
    columns = dict.fromkeys((*ACTIVITY_COLUMNS, *NETWORK_COLUMNS, *PERMISSION_COLUMNS))
    inputs = tuple(f"{view.name}:{c}" for c in columns if c in view.field_names())
    return OnDemandView("malware_derived_features", inputs, tuple(SCORE_FIELDS.items()), with_on_demand_scores)


def family_view(source: str = "dim_malware_families", timestamp_field: str = "_dbt_loaded_at") -> FeatureView:
    """One row of statistics per family, stamped with the time it was loaded."""
    return FeatureView("malware_family_features", ("family_statistics",), tuple(FAMILY_FIELDS.items()), timestamp_field, source, online=True)


def sample_registry(source: str = "fct_training_dataset", timestamp_field: str = "feature_timestamp") -> Registry:
    """The sample view for retrieval and serving, its four-field training view, the family view and the derived scores."""
    sample_fields = (
        *TARGET_FIELDS.items(),
        *((n, T.LongType()) for n in SYSCALL_FIELDS),
        *TOTAL_FIELDS.items(),
        *((n, T.LongType()) for n in PERMISSION_FIELDS),
    )
    kinds = dict(sample_fields)
    batch_fields = tuple((n, kinds[n]) for n in ("malware", "nr_syscalls", "nr_permissions", "detection_ratio"))
    shared = {"entities": ("malware_sample",), "timestamp_field": timestamp_field, "source": source, "ttl": SAMPLE_TTL}
    samples = FeatureView("malware_sample_features", fields=sample_fields, online=True, **shared)
    batch = FeatureView("malware_batch_features", fields=batch_fields, **shared)
    return Registry(ENTITIES, (samples, batch, family_view()), (on_demand_scores(samples),))
