import numpy as np
import pytest

from centigram.operators.scaling import (
    METHODS,
    assembler_stage,
    scale_columns,
    scaler_stage,
    vector_columns,
)

XY = ("x", "y")


@pytest.fixture
def frame(spark):
    def make(*rows):
        return spark.createDataFrame(rows, "x double, y double")

    return make


def scaled(df, method):
    rows = scale_columns(df, XY, method).orderBy("x").collect()
    return np.array([[r["scaled_x"], r["scaled_y"]] for r in rows])


def test_constant_column(frame):
    df = frame((1.0, 5.0), (2.0, 5.0), (4.0, 5.0))
    expected = {
        "standard": ([-0.8728715609, -0.2182178902, 1.0910894512], 0.0),
        "minmax": ([0.0, 1 / 3, 1.0], 0.5),
        "maxabs": ([0.25, 0.5, 1.0], 1.0),
        "robust": ([-2 / 3, 0.0, 4 / 3], 0.0),
    }
    for method, (x, y) in expected.items():
        np.testing.assert_allclose(scaled(df, method), [[v, y] for v in x], atol=1e-9)


def test_zero_column(frame):
    df = frame((1.0, 0.0), (2.0, 0.0))
    assert scaled(df, "maxabs")[:, 1].tolist() == [0.0, 0.0]


@pytest.mark.parametrize("method", ["standard", "minmax", "maxabs"])
def test_equals_the_ml_stage(frame, method):
    rng = np.random.default_rng(1)
    df = frame(*[(float(a), 5.0 if i else float(b)) for i in (0,) for a, b in rng.normal(3, 9, (200, 2))])
    assembled = assembler_stage(XY).transform(df)
    model = scaler_stage(method).fit(assembled)
    rows = vector_columns(model.transform(assembled), XY).orderBy("x").collect()
    ml = np.array([[r["scaled_x"], r["scaled_y"]] for r in rows])
    np.testing.assert_allclose(scaled(df, method), ml, atol=1e-12)


def test_equals_the_ml_stage_on_a_constant(frame):
    df = frame((1.0, 5.0), (2.0, 5.0), (4.0, 5.0))
    for method in ("standard", "minmax", "maxabs"):
        assembled = assembler_stage(XY).transform(df)
        out = vector_columns(scaler_stage(method).fit(assembled).transform(assembled), XY)
        ml = np.array([[r["scaled_x"], r["scaled_y"]] for r in out.orderBy("x").collect()])
        np.testing.assert_allclose(scaled(df, method), ml, atol=1e-12)


def test_robust_stage_is_close_to_exact(frame):
    df = frame(*[(float(i), float(i * i % 97)) for i in range(500)])
    assembled = assembler_stage(XY).transform(df)
    model = scaler_stage("robust").fit(assembled)
    out = vector_columns(model.transform(assembled), XY).orderBy("x").collect()
    ml = np.array([[r["scaled_x"], r["scaled_y"]] for r in out])
    np.testing.assert_allclose(scaled(df, "robust"), ml, atol=0.05)


def test_null_stays_null(frame):
    df = frame((None, 1.0), (2.0, 3.0), (4.0, 5.0))
    for method in METHODS:
        rows = scale_columns(df, XY, method).filter("x IS NULL").collect()
        assert rows[0]["scaled_x"] is None and rows[0]["scaled_y"] is not None


def test_null_fails_vector_assembly_by_default(frame):
    with pytest.raises(Exception):
        assembler_stage(XY).transform(frame((None, 1.0), (1.0, 1.0))).collect()
    kept = assembler_stage(XY, "keep").transform(frame((None, 1.0)))
    assert kept.count() == 1


def test_unknown_method(frame):
    with pytest.raises(ValueError):
        scaler_stage("other")
    with pytest.raises(ValueError):
        scale_columns(frame((1.0, 1.0)), XY, "other")


def test_missing_vector(frame):
    with pytest.raises(ValueError):
        vector_columns(frame((1.0, 1.0)), XY)


def test_empty_input(frame):
    for method in METHODS:
        empty = scale_columns(frame((1.0, 1.0)).limit(0), XY, method)
        assert empty.columns == ["x", "y", "scaled_x", "scaled_y"] and empty.count() == 0
