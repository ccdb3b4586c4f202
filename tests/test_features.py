import math

import pytest

from tidemark.operators import features as fe


@pytest.fixture(scope="module")
def stats(eight, roles):
    return fe.fit(eight, roles)


@pytest.fixture(scope="module")
def rows(eight, edges, roles, stats):
    return {r.customerID: r for r in fe.transform(eight.union(edges), roles, stats).collect()}


def test_fitted_numbers(stats):
    # monthly, and total per month: 22 31 37 48 76 88 96 104
    assert stats.scalars["median_monthly"] == 62.0
    assert stats.scalars["median_avg_charge"] == 62.0
    assert stats.edges == [-math.inf, 35.5, 62.0, 90.0, math.inf]
    assert stats.scalars["global_rate"] == 0.5
    assert stats.scalars["global_tenure"] == 29.625
    table = {(r.feature, r.category): r for r in stats.categories.collect()}
    monthly = table[("Contract", "Month-to-month")]
    assert (monthly.rate, monthly.ordinal, monthly.n) == (1.0, 0, 3)
    assert monthly.tenure_mean == pytest.approx(49 / 3)
    assert table[("Contract", "Two year")].ordinal == 2
    assert table[("Contract", "One year")].ordinal == 1
    assert table[("InternetService", "Fiber optic")].rate == pytest.approx(2 / 3)


def test_all_columns(eight, roles, stats):
    made = set(fe.transform(eight, roles, stats).columns) - set(eight.columns)
    assert len(made) == 48


def test_base_features(rows):
    a, c, i, k = rows["A"], rows["C"], rows["I"], rows["K"]
    assert (a.new_customer_flag, i.new_customer_flag) == (0, 1)
    assert [rows[x].tenure_group for x in "ACDEFGH"] == ["0-6m", "7-12m", "1-2a", "2-4a", "2-4a", "4-6a", "4-6a"]
    assert k.tenure_group is None
    assert (i.tenure_group, i.avg_monthly_charge, i.TotalCharges) == ("0-6m", 0.0, 0.0)
    assert rows["L"].charges_mismatch_flag == 1 and c.charges_mismatch_flag == 0
    assert rows["J"].charges_mismatch_flag == 0
    assert (a.is_monthly_contract, c.is_monthly_contract, c.long_term_contract) == (1, 0, 1)
    assert (rows["L"].is_monthly_contract, rows["L"].long_term_contract) == (0, 0)
    assert [rows[x].MonthlyCharges_binned for x in "ACEBG"] == ["muito_baixo", "baixo", "medio", "alto", "alto"]
    assert (rows["B"].price_sensitive_contract, a.price_sensitive_contract) == (1, 0)
    assert (rows["B"].is_high_MonthlyCharges, a.is_high_MonthlyCharges) == (1, 0)
    assert (a.early_churn_risk, rows["F"].early_churn_risk) == (1, 0)
    assert a.MonthlyCharges_log == pytest.approx(math.log1p(31.0))
    assert c.TotalCharges_squared == 230400.0
    assert rows["J"].TotalCharges_log is None


def test_segments_and_fallbacks(rows):
    assert rows["A"].tenure_vs_contract_avg == pytest.approx(6 / 49)
    assert rows["M"].tenure_vs_contract_avg == pytest.approx(10 / 29.625)
    assert (rows["M"].contract_risk_ordinal, rows["M"].contract_churn_rate) == (0, 0.5)
    assert (rows["L"].contract_risk_ordinal, rows["L"].contract_churn_rate) == (0, 0.5)
    # unweighted mean of the rates: DSL 1/2, fibre 2/3, none 0
    assert rows["M"].internet_risk == pytest.approx((1 / 2 + 2 / 3 + 0) / 3)


def test_services_count_null_as_active(rows):
    a, g, l = rows["A"], rows["G"], rows["L"]
    assert (a.total_services, a.streaming_services, a.security_services) == (2, 0, 0)
    assert (g.total_services, g.has_streaming, g.has_security, g.security_services) == (8, 1, 1, 3)
    assert rows["D"].total_services == 1
    assert (l.total_services, l.has_streaming, l.security_services) == (4, 1, 1)
    assert a.service_density == pytest.approx(2 / 9)


def test_flags_and_scores(rows):
    a, b, d = rows["A"], rows["B"], rows["D"]
    assert (a.low_engagement, rows["G"].high_engagement) == (1, 1)
    assert (a.digital_only, d.digital_only, rows["L"].digital_only, rows["C"].digital_only) == (1, 1, 0, 0)
    assert (d.family_account, d.family_stability, rows["C"].family_stability) == (1, 1, 0)
    assert (b.fiber_no_security, b.streamer_unprotected, b.senior_monthly) == (1, 1, 1)
    assert d.streamer_unprotected == 0
    assert rows["I"].new_high_value == 0
    assert a.churn_risk_score == 2 + 2 + 1 + 0.5 + 1
    assert b.churn_risk_score == 2 + 2 + 1.5 + 0.5 + 1
    assert (b.high_risk_flag, b.very_high_risk_flag, rows["H"].high_risk_flag) == (1, 1, 0)


def test_lifecycle_and_value(rows):
    assert [(r.lifecycle_new, r.lifecycle_early, r.lifecycle_mid, r.lifecycle_mature) for r in map(rows.get, "ACEG")] == [
        (1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1)]
    assert (rows["C"].tenure_years, rows["E"].tenure_sqrt) == pytest.approx((10 / 12, math.sqrt(30)))
    assert rows["E"].estimated_clv == 2280.0
    assert (rows["I"].value_per_month, rows["C"].value_per_month) == (40.0, 48.0)
    assert rows["A"].cost_per_service == pytest.approx(31.0 / 2)


def test_fit_ignores_other_rows(eight, edges, roles, stats):
    again = fe.fit(eight.repartition(5), roles)
    assert again.scalars == stats.scalars and again.edges == stats.edges


def test_fit_without_target(eight, roles):
    bare = fe.fit(eight.drop("Churn"), roles)
    made = fe.transform(eight.drop("Churn"), roles, bare)
    assert not {"contract_churn_rate", "internet_risk"} & set(made.columns)
    assert "tenure_vs_contract_avg" in made.columns and made.count() == 8


def test_absent_services_are_not_counted(eight, roles, stats):
    less = eight.drop("PhoneService", "StreamingTV", "StreamingMovies")
    row = fe.transform(less, roles, stats).where("customerID = 'G'").first()
    assert (row.total_services, row.streaming_services, row.has_streaming) == (5, 0, 0)
    assert row.service_density == pytest.approx(5 / 6)


def test_equal_quartiles_use_even_edges():
    assert fe.open_edges([1.0, 1.0, 1.0, 2.0, 9.0]) == [-math.inf, 3.0, 5.0, 7.0, math.inf]


def test_saved_statistics_give_the_same_columns(spark, eight, roles, stats, tmp_path):
    stats.save(spark, str(tmp_path))
    loaded = fe.FeatureStats.load(spark, str(tmp_path))
    assert loaded.scalars == stats.scalars and loaded.edges == stats.edges
    order = lambda s: sorted(map(str, fe.transform(eight, roles, s).collect()))
    assert order(loaded) == order(stats)
