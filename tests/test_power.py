"""Power of the two-sample t test against published sizes and against simulation-free identities."""

import pytest

from kerbcast.functions.student import noncentral_cdf, rows_for_power, two_sample_power, two_sided_p
from kerbcast.operators import abtest


@pytest.mark.parametrize("effect, power, n", [
    # Published tables of rows per group, two-sided test at 5 %.
    (0.2, 0.8, 393.41), (0.5, 0.8, 63.77), (0.8, 0.8, 25.52), (0.5, 0.9, 85.03), (1.0, 0.8, 16.71)])
def test_published_sizes(effect, power, n):
    assert rows_for_power(effect, 0.05, power) == pytest.approx(n, abs=0.01)
    assert two_sample_power(rows_for_power(effect, 0.05, power), effect, 0.05) == pytest.approx(power)


def test_noncentral_without_shift_is_the_t_distribution():
    for t, dof in ((0.3, 4), (1.7, 11), (2.5, 60)):
        assert noncentral_cdf(t, dof, 0.0) == pytest.approx(1 - two_sided_p(t, dof) / 2)
        assert noncentral_cdf(-t, dof, 0.0) == pytest.approx(two_sided_p(t, dof) / 2)
        assert noncentral_cdf(t, dof, 1.2) == pytest.approx(1 - noncentral_cdf(-t, dof, -1.2))


def test_one_row(spark):
    errors = spark.createDataFrame([(float(v),) for v in (0, 2, 4, 0, 2, 4)], "abs_error double")
    row = abtest.exact_power_analysis(errors).first()
    assert row.n_needed == -(-row.n_exact // 1) and row.n_exact == pytest.approx(rows_for_power(row.effect_size, 0.05, 0.8))
    assert not row.powered and row.n_actual == 6
    flat = abtest.exact_power_analysis(errors.selectExpr("1.0D as abs_error")).first()
    assert flat.n_exact is None and flat.powered is None
    assert abtest.exact_power_analysis(errors.limit(0)).first().n_needed is None
