"""Every registered query of this part of the library against its SQL, on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from lifemart import registry
from lifemart.plans import load_all

load_all()
FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


#: Queries that no SQL holds, and the test that does.
HELD_BY = {
    "dp20_matched_attribution": "test_pairs.py::test_people",
    "fc21_block_bootstrap": "test_values.py::test_block_bootstrap",
    "ml01_random_forest": "test_values.py::test_models_are_sound",
    "ml02_logistic": "test_fits.py::test_logistic_scores_later_leads",
    "ml03_unit_sale_probability": "test_fits.py::test_unit_sale_probability",
    "ml04_fall_risk_benchmark": "test_values.py::test_models_are_sound",
    "ml06_logit_table": "test_evidence.py::test_parameter_queries",
    "ml06_ols_table": "test_evidence.py::test_parameter_queries",
    "ml06_project_parameters": "test_evidence.py::test_parameter_queries",
    "ml07_ipw_ate": "test_values.py::test_propensities_balance",
    "ml12_calibration_bins": "test_fits.py::test_calibration_bins",
    "ml12_latent_segments": "test_fits.py::test_latent_segments_keep_the_mean",
    "ml13_reason_topics": "test_values.py::test_models_are_sound",
    "ml16_linear_trend_forecast": "test_values.py::test_trend_forecast",
    "ml18_poisson_counts": "test_values.py::test_poisson_counts",
    "ml19_censored_duration": "test_fits.py::test_censored_durations",
    "ml19_cox": "test_evidence.py::test_cox_query",
    "ml20_rdd": "test_values.py::test_discontinuity",
    "ml21_synthetic_control": "test_pairs.py::test_synthetic_control_all_donors",
    "ml22_t_learner": "test_fits.py::test_uplift_quantiles_are_those_of_two_models",
    "ml25_auto_baseline": "test_values.py::test_models_are_sound",
    "ml25_auto_regression": "test_values.py::test_models_are_sound",
    "ml27_inertia_curve": "test_values.py::test_models_are_sound",
    "ml27_kmeans_segments": "test_fits.py::test_kmeans_segments",
    "ml29_partial_dependence": "test_evidence.py::test_parameter_queries",
    "ml29_permutation_all": "test_evidence.py::test_parameter_queries",
    "ml29_permutation_importance": "test_fits.py::test_permutation_importance",
    "ml29_sensitivity": "test_evidence.py::test_parameter_queries",
    "sc09_match_scores": "test_pairs.py::test_people",
    "src13_sanitized_project_month": "test_values.py::test_sanitized_project_month",
    "tk07_best_person": "test_pairs.py::test_people",
    "udf03_pair_similarity": "test_pairs.py::test_name_pairs",
    "udf04_series_profile": "test_series.py::test_profiles_of_projects",
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 5) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


@pytest.fixture
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    frame = registry.QUERIES[name](spark, FOLDER)
    rows = Counter(tuple(map(plain, r)) for r in frame.select(sorted(frame.columns)).collect())
    if name not in registry.ORACLES:
        file, _, test = HELD_BY[name].partition("::")
        assert f"def {test}(" in (Path(__file__).parent / file).read_text()
        return
    result = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    order = [names.index(n) for n in sorted(names)]
    assert rows == Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())
