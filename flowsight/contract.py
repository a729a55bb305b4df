"""Table contracts: column types and roles that the operators work from."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def ddl(text: str) -> T.StructType:
    """Schema from ``name type [not null], ...``; unlike Spark's own this needs no session."""
    fields = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], not rest) for name, kind, *rest in fields])


@dataclass(frozen=True)
class Contract:
    """A labelled table: one identifier, text and number features, a class name and a 0/1 label."""

    schema: T.StructType
    identifier: str
    categorical: tuple[str, ...]
    category: str
    label: str
    category_names: Mapping[str, str] = field(default_factory=dict)
    negative_name: str = "Normal"

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def numeric(self) -> list[str]:
        other = {self.identifier, self.category, self.label, *self.categorical}
        return [name for name in self.columns if name not in other]

    def is_floating(self, name: str) -> bool:
        return isinstance(self.schema[name].dataType, (T.DoubleType, T.FloatType))

    def project(self, df: DataFrame) -> DataFrame:
        """The contract's columns in the contract's order; anything else is left out."""
        require_columns(df, self.columns)
        return df.select(*self.columns)


@dataclass(frozen=True)
class RawLayout:
    """A headerless text table: how each token is read and where it goes in the contract."""

    columns: tuple[str, ...]
    ports: frozenset[str]
    longs: frozenset[str]
    doubles: frozenset[str]
    texts: frozenset[str]
    renames: Mapping[str, str]
    category: str = "attack_cat"
    label: str = "label"
    duration: str = "dur"
    packets: tuple[str, ...] = ("Spkts", "Dpkts")

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.columns])

    @property
    def numeric(self) -> list[str]:
        return [name for name in self.columns if name not in self.texts]

    def kind(self, name: str) -> str:
        for kind, names in (("port", self.ports), ("bigint", self.longs), ("double", self.doubles), ("text", self.texts)):
            if name in names:
                return kind
        return "int"


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")


def same_types(left: T.StructType, right: T.StructType) -> bool:
    """Compare data types only: Parquet does not keep the not-null flags."""
    return [f.dataType.simpleString() for f in left.fields] == [f.dataType.simpleString() for f in right.fields]


# The columns of the flow table, in file order, and their types.
FLOW_SCHEMA = ddl(
    "id int not null, dur double, proto string, service string, state string, "
    "spkts int, dpkts int, sbytes bigint, dbytes bigint, rate double, sttl int, dttl int, "
    "sload double, dload double, sloss int, dloss int, sinpkt double, dinpkt double, "
    "sjit double, djit double, swin int, stcpb bigint, dtcpb bigint, dwin int, "
    "tcprtt double, synack double, ackdat double, smean int, dmean int, trans_depth int, "
    "response_body_len bigint, ct_srv_src int, ct_state_ttl int, ct_dst_ltm int, "
    "ct_src_dport_ltm int, ct_dst_sport_ltm int, ct_dst_src_ltm int, is_ftp_login int, "
    "ct_ftp_cmd int, ct_flw_http_mthd int, ct_src_ltm int, ct_srv_dst int, "
    "is_sm_ips_ports int, attack_cat string, label int not null"
)

# Spelling of the class names, by lower-case name.
FLOW_CATEGORY_NAMES = {
    "analysis": "Analysis",
    "backdoor": "Backdoor",
    "backdoors": "Backdoor",
    "dos": "DoS",
    "exploits": "Exploits",
    "fuzzers": "Fuzzers",
    "generic": "Generic",
    "reconnaissance": "Reconnaissance",
    "shellcode": "Shellcode",
    "worms": "Worms",
}

FLOW = Contract(
    schema=FLOW_SCHEMA,
    identifier="id",
    categorical=("proto", "service", "state"),
    category="attack_cat",
    label="label",
    category_names=FLOW_CATEGORY_NAMES,
)

# The columns of the raw text table, in file order.
_RAW_FLOW_COLUMNS = tuple(
    "srcip sport dstip dsport proto state dur sbytes dbytes sttl dttl sloss dloss service "
    "Sload Dload Spkts Dpkts swin dwin stcpb dtcpb smeansz dmeansz trans_depth res_bdy_len "
    "Sjit Djit Stime Ltime Sintpkt Dintpkt tcprtt synack ackdat is_sm_ips_ports ct_state_ttl "
    "ct_flw_http_mthd is_ftp_login ct_ftp_cmd ct_srv_src ct_srv_dst ct_dst_ltm ct_src_ltm "
    "ct_src_dport_ltm ct_dst_sport_ltm ct_dst_src_ltm attack_cat label".split()
)

# Raw columns whose contract name is not simply their lower-case name.
_RAW_FLOW_RENAMES = {
    "smean": "smeansz",
    "dmean": "dmeansz",
    "response_body_len": "res_bdy_len",
    "sinpkt": "Sintpkt",
    "dinpkt": "Dintpkt",
}

RAW_FLOW = RawLayout(
    columns=_RAW_FLOW_COLUMNS,
    ports=frozenset("sport dsport".split()),
    longs=frozenset("stcpb dtcpb res_bdy_len Stime Ltime".split()),
    doubles=frozenset("dur Sload Dload Sjit Djit Sintpkt Dintpkt tcprtt synack ackdat".split()),
    texts=frozenset("srcip dstip proto state service attack_cat".split()),
    renames={**{name.lower(): name for name in _RAW_FLOW_COLUMNS}, **_RAW_FLOW_RENAMES},
)

# The streamed flow event; its time arrives as ISO text.
FLOW_EVENT_SCHEMA = ddl(
    "event_id string, run_id string, actor_id string, experiment_id string, lab_mode string, "
    "record_type string, timestamp string, source_ip string, source_port int, "
    "destination_port int, proto string, service string, dur double, sbytes bigint, dbytes bigint"
)
EVENT_TRUTH_SCHEMA = ddl("event_id string, label int")
RUN_TRUTH_SCHEMA = ddl("run_id string, scenario string, label int, lab_mode string, expected_flows bigint")
WINDOW_TRUTH_SCHEMA = ddl("timestamp string, source_ip string, label int, scenario string")
