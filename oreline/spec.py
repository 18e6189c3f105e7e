"""Declarations: entities, tables and where they are stored.

One ``EntitySpec`` drives all three stages of an entity (bronze log, silver
state, catalog tables), so adding an entity is adding a declaration.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def struct(columns: str) -> T.StructType:
    """``"id string, n int"`` -> StructType, without needing a running session."""
    pairs = (part.split() for part in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns of a change-stream record, as the Kafka source delivers them.
STREAM_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.StringType()),
    ]
)

# Envelope fields that can be carried into bronze, with their types.
ENVELOPE_META = {
    "op": T.StringType(),
    "ts_ms": T.LongType(),
    "ts_us": T.LongType(),
    "ts_ns": T.LongType(),
    "transaction": T.StringType(),
}

EVENT_DATE = "_event_date"
BATCH = "_batch"
BEFORE_KEY = "_before_key"
IMAGE = "_image"
VERSION = "_version"

# --- fixed values: intake, timeouts, metadata and keys ----------------------

INTAKE_LIMIT = 50_000
BOOKING_INTAKE_LIMIT = 200_000
TRIGGER_INTERVAL = "60 seconds"
SESSION_TIMEOUT_MS = "45000"
REQUEST_TIMEOUT_MS = "60000"

REPORT_KEYS = ("student_id", "class_regular_session_id")

# Everything bronze adds to the business columns; silver strips these.
BRONZE_META = (
    "_op",
    "_ts_ms",
    "_ts_us",
    "_ts_ns",
    "_transaction",
    "_kafka_topic",
    "_kafka_partition",
    "_kafka_offset",
    "_kafka_timestamp",
    "_ingested_at",
    EVENT_DATE,
    BATCH,
    BEFORE_KEY,
    IMAGE,
)

# --- end of fixed values -----------------------------------------------------


@dataclass(frozen=True)
class EntitySpec:
    """A captured source table.

    ``meta`` lists the envelope fields kept in bronze. ``before_key`` also keeps
    the key of the ``before`` image, which is the only place a delete event
    carries its key; it is needed for ``deletes="apply"``. ``parts`` is the number of
    folders that silver is dealt to by the hash of its key when it is first written: a
    merge rewrites those that it has keys for. A gigabyte each is a good size.
    ``image`` keeps the whole row image in bronze as well, declared or not, so that a
    column the source has gained is not lost before it is declared.
    """

    name: str
    columns: str
    key: str = "id"
    meta: tuple[str, ...] = ("op", "ts_ms")
    before_key: bool = False
    image: bool = False
    parts: int = 16
    max_per_trigger: int = INTAKE_LIMIT
    trigger: str = TRIGGER_INTERVAL
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    options: dict[str, str] = field(default_factory=dict, hash=False)
    topic_prefix: str = "cdc"
    description: str = ""

    @property
    def topic(self) -> str:
        return f"{self.topic_prefix}.{self.name}"

    @property
    def after_schema(self) -> T.StructType:
        return struct(self.columns)

    @property
    def bronze_schema(self) -> T.StructType:
        fields = [T.StructField(f"_{m}", ENVELOPE_META[m]) for m in self.meta]
        fields += [
            T.StructField("_kafka_topic", T.StringType()),
            T.StructField("_kafka_partition", T.IntegerType()),
            T.StructField("_kafka_offset", T.LongType()),
            T.StructField("_kafka_timestamp", T.TimestampType()),
        ]
        if self.before_key:
            fields.append(T.StructField(BEFORE_KEY, self.after_schema[self.key].dataType))
        if self.image:
            fields.append(T.StructField(IMAGE, T.VariantType()))
        fields += self.after_schema.fields
        fields += [
            T.StructField("_ingested_at", T.TimestampType()),
            T.StructField(EVENT_DATE, T.DateType()),
            T.StructField(BATCH, T.StringType()),
        ]
        return T.StructType(fields)

    @property
    def silver_schema(self) -> T.StructType:
        fields = [
            T.StructField(f.name, f.dataType, f.name != self.key) for f in self.after_schema.fields
        ]
        return T.StructType(fields + [T.StructField("_silver_updated_at", T.TimestampType())])


@dataclass(frozen=True)
class TableSpec:
    """A catalog table: enough to render its DDL and to read it by path.

    ``dealt`` tables lie in folders by the hash of their key, which is no column of theirs.
    """

    database: str
    name: str
    schema: T.StructType
    path: str
    partition_by: tuple[str, ...] = ()
    dealt: bool = False
    fmt: str = "parquet"
    properties: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def qualified(self) -> str:
        return f"{self.database}.{self.name}"


# --- fixed values: source columns, in source order -------------------------

CLASS_SESSION_COLUMNS = (
    "id string, class_in_id string, class_in_session_id string, learn_date int, code string, "
    "status string, day_of_week string, number_of_students int, week_studying string, notes string, "
    "class_regular_id string, class_time_slot_id string, grade_id string, level_id string, "
    "teacher_id bigint, created_by string, created_at bigint, updated_by string, updated_at bigint, "
    "study_program_id string, session_type string, init_monitor_id string, folder_id string, "
    "chairman_teacher_id bigint, ordinal_number_on_week int, exam_type string, backup_status string, "
    "class_room_id string, class_in_acct_search_status string, mgmt_class_in_acct_id string"
)

SESSION_STUDENT_COLUMNS = (
    "id string, class_regular_session_id string, student_id bigint, status string, notes string, "
    "created_by string, created_at bigint, updated_by string, updated_at bigint"
)

MONTHLY_REPORT_COLUMNS = (
    "id string, student_id bigint, full_name string, phone string, grade string, level string, "
    "sync_date int, month_of_report int, created_by string, created_at bigint, updated_by string, "
    "updated_at bigint, pss1_learning int, pss2_attitude int, pss3_english int, "
    "number_sessions_per_week int, pss_total_score double, pss_note string, eligible_calculate_ps string"
)

STUDY_PROGRAM_COLUMNS = (
    "id string, name string, max_student_in_class int, subject_id string, created_by string, "
    "created_at bigint, updated_by string, updated_at bigint, code string, type string, "
    "product_type_code string, group_type string, sessions_per_week int, learning_model string, "
    "schedule_type string"
)

GRADE_COLUMNS = (
    "id string, name string, code string, value int, created_by string, created_at bigint, "
    "updated_by string, updated_at bigint"
)

REPORT_COLUMNS = (
    "learn_date date, student_id bigint, class_regular_session_id string, study_program string, "
    "_gold_updated_at timestamp"
)

REPORT_STATUSES = ("SUCCESS", "FAILED_STUDENT_NO_LEARNED")

# (label, lowest grade value, highest grade value); anything else is OTHER_BAND.
GRADE_BANDS = (("Tiểu học", 1, 5), ("THCS", 6, 9))
OTHER_BAND = "Others"

# --- end of fixed values -----------------------------------------------------

ENTITIES = {
    spec.name: spec
    for spec in (
        EntitySpec(
            "class_regular_session",
            CLASS_SESSION_COLUMNS,
            meta=("op", "ts_ms", "ts_us", "ts_ns"),
            options={"kafka.session.timeout.ms": SESSION_TIMEOUT_MS, "kafka.request.timeout.ms": REQUEST_TIMEOUT_MS},
            description="class sessions",
        ),
        EntitySpec(
            "class_regular_session_student",
            SESSION_STUDENT_COLUMNS,
            max_per_trigger=BOOKING_INTAKE_LIMIT,
            description="students booked on class sessions",
        ),
        EntitySpec(
            "report_monthly_learning_student_info",
            MONTHLY_REPORT_COLUMNS,
            description="monthly learning report per student",
        ),
        EntitySpec("study_program", STUDY_PROGRAM_COLUMNS, description="study programs"),
        EntitySpec("grade", GRADE_COLUMNS, description="school grades"),
    )
}

REPORT_NAME = "student_session_report"
REPORT_PARTITION = "learn_date"


@dataclass(frozen=True)
class Layout:
    """Derives every path and table of a lakehouse from one root."""

    root: str
    fmt: str = "parquet"
    table_prefix: str = ""

    def _path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}.db/{name}"

    def bronze_path(self, entity: EntitySpec) -> str:
        return self._path("bronze", entity.name)

    def silver_path(self, entity: EntitySpec) -> str:
        return self._path("silver", entity.name)

    def gold_path(self, name: str = REPORT_NAME) -> str:
        return self._path("gold", name)

    def removed_path(self, entity: EntitySpec) -> str:
        """Keys that deletes have taken out of silver."""
        return self._path("silver", f"{entity.name}__removed")

    def cursor_path(self, name: str) -> str:
        """How far a consumer has come: an entity's silver job in its log, or the report in its inputs."""
        return f"{self.root.rstrip('/')}/_cursors/{name}"

    def checkpoint_path(self, entity: EntitySpec) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/bronze.db/{entity.name}"

    def bronze_table(self, entity: EntitySpec) -> TableSpec:
        # Batches are folders of the plain Parquet log only; other formats append transactionally.
        batches = self.fmt == "parquet"
        fields = [f for f in entity.bronze_schema.fields if batches or f.name != BATCH]
        return TableSpec(
            "bronze",
            self.table_prefix + entity.name,
            T.StructType(fields),
            self.bronze_path(entity),
            partition_by=(EVENT_DATE, BATCH) if batches else (EVENT_DATE,),
            fmt=self.fmt,
            properties={
                "description": f"Bronze change log: {entity.description or entity.name}",
                "source.topic": entity.topic,
                "layer": "bronze",
            },
        )

    def silver_table(self, entity: EntitySpec) -> TableSpec:
        return TableSpec(
            "silver",
            self.table_prefix + entity.name,
            entity.silver_schema,
            self.silver_path(entity),
            dealt=self.fmt == "parquet",
            fmt=self.fmt,
            properties={
                "description": f"Silver current state: {entity.description or entity.name}",
                "layer": "silver",
            },
        )

    def report_table(self) -> TableSpec:
        return TableSpec(
            "gold",
            self.table_prefix + REPORT_NAME,
            struct(REPORT_COLUMNS),
            self.gold_path(),
            partition_by=(REPORT_PARTITION,),
            fmt=self.fmt,
            properties={
                "description": "Sessions booked by students, by learn date, with their programs",
                "layer": "gold",
            },
        )
