"""Catalogue of registered queries (Spark callables) and their oracles.

Every callable takes ``(spark, sf_dir)``, reads the driver tables in
``sf_dir`` (whole tables) and returns a DataFrame whose columns carry the
same names as the oracle statement.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import measures as M
from ..operators.judge import EvalOptions, judge, topic_stats
from ..sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def register(name: str, oracle: Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _eval_long(df: DataFrame) -> DataFrame:
    return df.select("run_id", "qid", "measure", r6("value").alias("value"))


# ------------------------------------------------------------ measures
MEASURE_QUERIES = ["num_q", "num_ret", "num_rel", "num_rel_ret", "num_nonrel_judged_ret", "map", "gm_map",
                   "Rprec", "bpref", "gm_bpref", "recip_rank", "iprec_at_recall", "11pt_avg", "P", "recall",
                   "relative_P", "success", "map_cut", "Rprec_mult", "unj", "infAP", "binG", "yaap", "set_P",
                   "set_relative_P", "set_recall", "set_map", "set_F", "utility", "dcg", "ideal_dcg", "ndcg",
                   "ndcg_cut", "rbp", "rbp_resid", "G", "ndcg_rel", "Rndcg"]


def _measure_query(name: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _eval_long(M.evaluate(fx.runs(spark, sf_dir), fx.qrels(spark, sf_dir), [name]))
    return q


def _measure_oracle(name: str):
    def o() -> str:
        from checks import oracle as O
        return O.measure_query(name)
    return o


for _n in MEASURE_QUERIES:
    register(f"m_{_n}", _measure_oracle(_n))(_measure_query(_n))


def queries() -> dict:
    _load_all()
    return dict(QUERIES)


def oracles() -> dict:
    _load_all()
    return {k: v() for k, v in ORACLES.items()}


def _load_all():
    # Modules registering further queries.
    from . import catalog_eval, catalog_files, catalog_search, catalog_sources, catalog_sweep  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import catalog_eval
    return catalog_eval.flagship(spark, sf_dir)
