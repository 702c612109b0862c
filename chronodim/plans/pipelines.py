"""The seventeen dimension loads as named specs, and their bindings to the
test fixtures.

Column names are the warehouse's own.  A binding derives every dimension and
staging column of a spec from a fixture's columns by a plain SQL expression,
so the seventeen loads differ as the original scripts do and run unchanged on
real tables.  Binding expressions are SQL text valid in both Spark SQL and
DuckDB, which lets the oracle reuse them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import fixtures as fx
from ..spec import BOOKKEEPING, DimSpec

BATCH_TS = "2024-01-15 12:00:00"      # the fixed batch clock of the tests


def _same(*names):
    return tuple((n, n) for n in names)


def _pairs(*items):
    """``"dim<src"`` or ``"name"`` (same name on both sides)."""
    out = []
    for it in items:
        d, _, s = it.partition("<")
        out.append((d, s or d))
    return tuple(out)


# ---- specs ---------------------------------------------------------------------------
# The warehouse's dimension names and its dimension / staging
# column names (as the loads read and write them), written in their order.
BANK_TERMINAL = DimSpec(
    name="dw_dim_bank_terminal",
    keys=_pairs("utid<src_utid", "acq_bank_code<src_acq_bank_code", "btid<src_btid",
                "inno_scheme_model_code<src_inno_scheme_model_code"),
    tracked=_pairs("bank_merchant_id<src_bank_merchant_id", "saletype<src_saletype", "btid_state<src_btid_state",
                   "crtupd_status<src_crtupd_status", "crtupd_dt<src_crtupd_dt", "crtupd_user<src_crtupd_user",
                   "bank_stan_no<src_bank_stan_no", "batch_srl_no<src_batch_srl_no", "invoice_no<src_invoice_no",
                   "on_us_off_us<src_on_us_off_us"),
    payload=_pairs("general_purpose_utid<src_utid"),
    ts="src_crtupd_dt",
)

_CHAIN_ATTRS = _pairs("chain_name", "category<chain_category", "address1<chain_adr1", "address2<chain_adr2",
                      "address3<chain_adr3", "pin_code<pincode", "city_id", "state_id", "chain_website",
                      "billing_gst_number<billing_gstn", "shipping_gst_number<shipping_gstn", "merchant_id")
CHAIN_APPEND = DimSpec(name="dw_dim_chain", keys=_pairs("chain_code<chain_id"), tracked=_CHAIN_ATTRS,
                       carry=_pairs("configuration_date<crtupd_dt"), ts="crtupd_dt", mode="append_all")
CHAIN_UPSERT = DimSpec(name="dw_dim_chain", keys=_pairs("chain_code<chain_id"), tracked=_CHAIN_ATTRS,
                       carry=_pairs("configuration_date<crtupd_dt"), ts="crtupd_dt")

MERCHANT = DimSpec(
    name="dw_dim_merchant",
    keys=_pairs("merchant_code<mer_id"),
    tracked=_pairs("merchant_name<mer_name", "category<mer_category", "address1<mer_adr1", "address2<mer_adr2",
                   "address3<mer_adr3", "pin_code<pincode", "city_id", "state_id", "merchant_website<mer_website",
                   "nac", "is_reliance_card_enabled", "mcc_code", "do_business_as"),
    carry=_pairs("configuration_date<crtupd_dt"),
    ts="crtupd_dt",
)

_STORE_TRACKED = _pairs("store_name", "address1<store_adr1", "address2<store_adr2", "address3<store_adr3",
                        "pin_code<pincode", "city_id", "state_id", "store_website<str_website",
                        "billing_gst_number", "shipping_gst_number")
_STORE_PAYLOAD = _pairs("chain_id<lkp_chain_id", "mer_store_code")
STORE_APPEND = DimSpec(name="dw_dim_store", keys=_pairs("store_code"), tracked=_STORE_TRACKED,
                       payload=_STORE_PAYLOAD, carry=_pairs("configuration_date<crtupd_dt"), ts="crtupd_dt",
                       mode="append_all")
STORE_UPSERT = DimSpec(name="dw_dim_store", keys=_pairs("store_code"), tracked=_STORE_TRACKED,
                       payload=_STORE_PAYLOAD, carry=_pairs("configuration_date<crtupd_dt"), ts="crtupd_dt")

UTID = DimSpec(
    name="dw_dim_utid",
    keys=_pairs("utid"),
    tracked=_pairs("primary_communication_id", "secondary_communication_id", "installationdate", "store_id"),
    payload=_pairs("general_purpose_utid<utid"),
    ts="crtupd_dt",
)

PAN_INFO = DimSpec(name="dw_dim_acquirer_pan_info", keys=_pairs("acq_bank_code", "panlow"),
                   tracked=_pairs("panhigh", "panlenrange", "cardlabel"), ts="crtupd_dt")

ACQUIRING_BANK = DimSpec(
    name="dw_dim_acquiring_bank",
    keys=_pairs("acq_bank_code"),
    tracked=_pairs("acq_bank_name", "primary_ipaddress", "primary_portno", "secondary_ipaddress",
                   "secondary_portno", "primary_flag", "secondary_flag", "acq_bank_desc", "isactive",
                   "crtupd_reason", "crtupd_status", "crtupd_user"),
    payload=_pairs("country_id", "acq_bank_disclaimer"),
    ts="crtupd_dt",
)

BTID = DimSpec(
    name="dw_dim_btid",
    keys=_pairs("btid", "bank_merchant_id", "panlow"),
    tracked=_pairs("hostindex", "cardtype", "panhigh", "panlenrange", "amtfloorlimit", "cardlabel",
                   "btid_issuedate", "btid_key_exchanged", "btid_key_exchanged_on", "mcc_code", "category",
                   "crtupd_status", "crtupd_user", "refund_allowed"),
    ts="crtupd_dt",
)

OWNER_CLOSE = DimSpec(name="dw_dim_chain_category_owner", keys=_pairs("category<src_category"),
                      tracked=_pairs("owner_name<src_owner_name"), ts="src_created_on",
                      mode="close_previous", start="batch", due="date")
OWNER_UPSERT = DimSpec(name="dw_dim_chain_category_owner", keys=_pairs("category<src_category"),
                       tracked=_pairs("owner_name<src_owner_name"), ts="src_created_on",
                       start="batch", retire="touched", redate="touched")

DC_EMI = DimSpec(name="dw_dim_dc_emi_partners", keys=_pairs("utid", "btid"),
                 tracked=_pairs("dc_emi_enabled", "issuing_bank_code"), ts="crtupd_dt")

CLASSIFICATION_APPEND = DimSpec(
    name="dw_dim_merchant_classification",
    keys=_pairs("merchant_code<src_merchant_code", "chain_code<src_chain_code"),
    tracked=_pairs("merchant_name<src_merchant_name", "industry<src_industry", "chain_name<src_chain_name",
                   "chain_category<src_chain_category", "is_migrated<src_is_migrated"),
    ts="src_created_on", mode="append_all",
)

MERCHANT_CHAIN = DimSpec(
    name="dw_dim_merchant",
    keys=_same("merchant_code", "chain_code"),
    tracked=_same("merchant_name", "industry", "chain_name", "chain_category", "is_migrated"),
    ts="created_on",
    version_partition=("merchant_code",),      # numbered per merchant, keyed per (merchant, chain)
    tiebreak=("chain_code",),
)

_KPI_KEYS = _pairs("kpi_name<src_kpi_name", "month<src_month", "year<src_year", "category<src_category")
KPI_CLOSE = DimSpec(name="dw_dim_monthly_kpi_target", keys=_KPI_KEYS, tracked=_pairs("target<src_target"),
                    ts="src_created_on", mode="close_previous", start="batch", due="midnight")
KPI_UPSERT = DimSpec(name="dw_dim_monthly_kpi_target", keys=_KPI_KEYS, tracked=_pairs("target<src_target"),
                     ts="src_created_on", start="batch", retire="touched", redate="touched")


# ---- fixture bindings ----------------------------------------------------------------
@dataclass(frozen=True)
class FixtureShape:
    """Logical columns of a fixture: name → (dimension column, staging column)."""
    keys: tuple[tuple[str, str], ...]
    attrs: dict
    ts: tuple[str, str]              # (dimension column, staging column) of the timestamp
    templates: tuple[str, ...]       # attribute expressions over the logical names
    extra_dim: tuple[str, ...] = ()  # fixture dimension columns kept as they are


SHAPES = {
    "fx1": FixtureShape(keys=(("k", "src_k"),), attrs={"seg": ("seg", "src_seg"), "nat": ("nat", "src_nat")},
                        ts=("date_from", "crtupd_dt"),
                        templates=("{seg}", "CAST({nat} AS STRING)", "lower({seg})", "{nat}",
                                   "{seg} || '/' || CAST({nat} AS STRING)"),
                        extra_dim=("configuration_date",)),
    "fx2": FixtureShape(keys=(("k1", "src_k1"), ("k2", "src_k2")),
                        attrs={"st": ("st", "src_st"), "amt": ("amt", "src_amt")},
                        ts=("date_from", "src_created_on"),
                        templates=("{st}", "{amt}", "lower({st})", "{amt} + 1", "{st} || '/'")),
    "fx3": FixtureShape(keys=(("k1", "k1"), ("k2", "k2"), ("k3", "k3")),
                        attrs={"ls": ("ls", "ls"), "qty": ("qty", "qty")},
                        ts=("date_from", "crtupd_dt"),
                        templates=("{ls}", "{qty}", "lower({ls})", "{qty} + 1", "{ls} || '/'")),
    "fx4": FixtureShape(keys=(("kpi_name", "src_kpi_name"), ("mon", "src_month"), ("yr", "src_year"),
                              ("category", "src_category")),
                        attrs={"target": ("target", "src_target")},
                        ts=("date_from", "src_created_on"),
                        templates=("{target}", "CAST({target} AS STRING)", "{target} + 1",
                                   "CAST({target} AS STRING) || '/'")),
}
# fixture variant → (builder, shape)
VARIANTS = {"fx1": "fx1", "fx2": "fx2", "fx3": "fx3", "fx4": "fx4"}


@dataclass(frozen=True)
class Pipeline:
    query: str
    spec: DimSpec
    fixture: str                      # key of fixtures.FIXTURES
    batch_ts: str | None = None
    overrides: dict = field(default_factory=dict)   # dim column → template ("{ts}" = timestamp)

    @property
    def shape(self) -> FixtureShape:
        return SHAPES[VARIANTS[self.fixture]]

    def bindings(self) -> tuple[dict, dict]:
        """(dimension column → SQL over the fixture dimension,
            staging column → SQL over the fixture staging batch)."""
        sh, spec = self.shape, self.spec
        logical_d = {n: d for n, (d, _) in sh.attrs.items()} | {"ts": sh.ts[0]}
        logical_s = {n: s for n, (_, s) in sh.attrs.items()} | {"ts": sh.ts[1]}
        dim, stg = {}, {}
        for (dcol, scol), (fd, fs) in zip(spec.keys, sh.keys):
            dim[dcol], stg[scol] = fd, fs
        for i, (dcol, scol) in enumerate(spec.tracked + spec.payload):
            if dcol in self.overrides:
                t = self.overrides[dcol]
            elif scol in stg:                 # one staging column feeding two targets (P2)
                src_key = next(d for d, s in spec.keys if s == scol)
                dim[dcol] = dim[src_key]
                continue
            else:
                t = sh.templates[i % len(sh.templates)]
            dim[dcol] = t.format(**logical_d)
            stg.setdefault(scol, t.format(**logical_s))
        for dcol, scol in spec.carry:
            dim[dcol] = dcol if dcol in sh.extra_dim else sh.ts[0]
            stg.setdefault(scol, sh.ts[1])
        stg.setdefault(spec.ts, sh.ts[1])
        return dim, stg

    def frames(self, spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, DataFrame]:
        fd, fs = fx.FIXTURES[self.fixture](spark, sf_dir, **options)
        dim_map, stg_map = self.bindings()
        attrs = [c for c in self.spec.dim_cols if c not in BOOKKEEPING]
        dim = fd.select(*[F.expr(dim_map[c]).alias(c) for c in attrs], *BOOKKEEPING)
        stg = fs.select(*[F.expr(e).alias(c) for c, e in stg_map.items()])
        return dim, stg


PIPELINES = {p.query: p for p in (
    Pipeline("pipe_bank_terminal", BANK_TERMINAL, "fx4", overrides={"crtupd_dt": "{ts}"}),
    Pipeline("pipe_chain_append", CHAIN_APPEND, "fx1"),
    Pipeline("pipe_chain_upsert", CHAIN_UPSERT, "fx1"),
    Pipeline("pipe_merchant", MERCHANT, "fx1"),
    Pipeline("pipe_store_append", STORE_APPEND, "fx1"),
    Pipeline("pipe_store_upsert", STORE_UPSERT, "fx1"),
    Pipeline("pipe_utid", UTID, "fx1"),
    Pipeline("pipe_pan_info", PAN_INFO, "fx2"),
    Pipeline("pipe_acquiring_bank", ACQUIRING_BANK, "fx1"),
    Pipeline("pipe_btid", BTID, "fx3"),
    Pipeline("pipe_owner_close", OWNER_CLOSE, "fx1", batch_ts=BATCH_TS),
    Pipeline("pipe_owner_upsert", OWNER_UPSERT, "fx1", batch_ts=BATCH_TS),
    Pipeline("pipe_dc_emi", DC_EMI, "fx2"),
    Pipeline("pipe_classification_append", CLASSIFICATION_APPEND, "fx2"),
    Pipeline("pipe_merchant_chain", MERCHANT_CHAIN, "fx2"),
    Pipeline("pipe_kpi_close", KPI_CLOSE, "fx4", batch_ts=BATCH_TS),
    Pipeline("pipe_kpi_upsert", KPI_UPSERT, "fx4", batch_ts=BATCH_TS),
)}


def run_pipeline(spark: SparkSession, sf_dir: str, name: str, split: str = "auto") -> DataFrame:
    from ..operators.ordered import kept_table
    from ..sources.io import read_dim, read_staging
    from .scd2 import apply_scd2
    p = PIPELINES[name]
    dim, stg = p.frames(spark, sf_dir, keep=kept_table)
    return apply_scd2(read_dim(spark, dim, p.spec), read_staging(spark, stg, p.spec), p.spec, p.batch_ts, split=split)


def run_bucketed(spark: SparkSession, sf_dir: str, name: str, n_buckets: int = 256, apart: bool = False) -> DataFrame:
    """The same load on a bucketed table in the shared folder (removed when the session ends):
    only touched buckets are read and written; ``apart``: of their closed versions only those that the load needs."""
    import uuid
    from ..operators.ordered import shared_root
    from ..sources.buckets import create_table, load_table, read_table
    p = PIPELINES[name]
    dim, stg = p.frames(spark, sf_dir)
    root = f"{shared_root(spark)}/bucketed-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    create_table(dim, root, p.spec.partition_cols, n_buckets, p.spec.key_cols if apart else None)
    load_table(spark, root, stg, p.spec, p.batch_ts)
    return read_table(spark, root)
