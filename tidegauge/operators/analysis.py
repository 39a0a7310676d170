"""Series kernels as grouped maps: one Arrow group for each series, one shuffle by ``ts_id``.

A kernel takes a series' values in time order and returns rows. A series that fails gives a row with its status and
message, never an exception; nulls are refused, as gaps are to be filled before.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tidegauge.kernels import series as K

Kernel = Callable[[np.ndarray], dict]
_STATUS = "status string, message string"
_PARTS = f"trend double, seasonal double, residual double, method string, period int, {_STATUS}"
_KERNELS: dict[str, tuple[Kernel, str, int]] = {}


def register_kernel(name: str, fn: Kernel, schema: str, least: int = 12) -> None:
    """Make ``fn`` runnable by name; ``schema`` is the DDL of what it returns for a series."""
    _KERNELS[name] = (fn, schema, least)


def kernels() -> list[str]:
    return sorted(_KERNELS)


def gate(x: np.ndarray, least: int) -> str | None:
    """Why a series can't be analysed, if so."""
    if len(x) < least:
        return f"{len(x)} rows, {least} needed"
    if not np.isfinite(x).all():
        return "missing or infinite values"
    if np.abs(x).max() > 1e10:
        return "values over 1e10"
    return None


def _grouped(df: DataFrame, value: str, schema: str, rows: Callable[[np.ndarray], pd.DataFrame], keep_time: bool) -> DataFrame:
    def call(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("open_time", kind="stable")
        out = rows(pdf["y"].to_numpy(float, na_value=np.nan))
        out.insert(0, "ts_id", pdf["ts_id"].iloc[0])
        if keep_time:
            out.insert(1, "open_time", pdf["open_time"].to_numpy())
        return out

    fields = df.select("ts_id", "open_time", df[value].cast("double").alias("y"))
    head = "ts_id string, open_time timestamp_ntz, " if keep_time else "ts_id string, "
    return fields.groupBy("ts_id").applyInPandas(call, head + schema)


def analyse(df: DataFrame, value: str, name: str) -> DataFrame:
    """One row for each series: the kernel's fields with status and message."""
    fn, schema, least = _KERNELS[name]
    names = [f.strip().split()[0] for f in schema.split(", ")]

    def rows(x: np.ndarray) -> pd.DataFrame:
        why = gate(x, least)
        try:
            got = fn(x) if why is None else {}
        except (ArithmeticError, ValueError, IndexError, np.linalg.LinAlgError) as e:
            got, why = {}, f"{type(e).__name__}: {e}"
        return pd.DataFrame([[got.get(n) for n in names] + ["error" if why else "success", why or ""]], columns=[*names, "status", "message"], dtype=object)

    return _grouped(df, value, f"{schema}, {_STATUS}", rows, False)


def decompose(df: DataFrame, value: str, method: str | None = None, period: int | None = None) -> DataFrame:
    """``trend, seasonal, residual`` beside every row, with method, period and status.

    Without a method one is chosen from length and detected period; without a period the detected one is used, else 24.
    Where the method fails or gives anything but numbers, STL's components stand in, with the reason in ``message``.
    """
    return _grouped(df, value, _PARTS, _decomposer(method, period), True)


def redecompose(df: DataFrame, value: str, stored: DataFrame) -> DataFrame:
    """Components by each series' own stored ``(ts_id, method, period)``, as an earlier run chose them; others choose anew."""

    def call(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("open_time", kind="stable")
        method, period = pdf["method"].iloc[0], pdf["period"].iloc[0]
        known = isinstance(method, str)
        out = _decomposer(method if known else None, int(period) if known and pd.notna(period) else None)(pdf["y"].to_numpy(float, na_value=np.nan))
        out.insert(0, "ts_id", pdf["ts_id"].iloc[0])
        out.insert(1, "open_time", pdf["open_time"].to_numpy())
        return out

    fields = df.select("ts_id", "open_time", df[value].cast("double").alias("y")).join(stored.select("ts_id", "method", "period"), "ts_id", "left")
    return fields.groupBy("ts_id").applyInPandas(call, f"ts_id string, open_time timestamp_ntz, {_PARTS}")


def clean_residual(df: DataFrame, value: str, method: str, outliers: str, period: int | None = None) -> DataFrame:
    """Decompose, replace the outliers of the residual, put the components together again: ``cleaned`` beside every row."""
    parts = decompose(df, value, method, period)
    rest = replace_outliers(parts.select("ts_id", "open_time", "residual"), "residual", outliers)
    both = parts.select("ts_id", "open_time", "trend", "seasonal").join(rest.withColumnRenamed("cleaned", "_rest"), ["ts_id", "open_time"])
    return both.select("ts_id", "open_time", "is_outlier", (both["trend"] + both["seasonal"] + both["_rest"]).alias("cleaned"))


def _decomposer(method: str | None, period: int | None) -> Callable[[np.ndarray], pd.DataFrame]:
    def rows(x: np.ndarray) -> pd.DataFrame:
        why = gate(x, 10) or (None if len(np.unique(x)) >= 3 else "under three distinct values")
        if why:
            empty = np.full(len(x), np.nan)
            return pd.DataFrame({"trend": empty, "seasonal": empty, "residual": empty, "method": None, "period": 0, "status": "error", "message": why})
        p = period or detect(x)["period"] or min(24, len(x) // 3)
        m = method or choose_method(x, p)
        for m in (m, "stl"):
            try:
                t, s, r = run_method(x, m, p)
                if np.isfinite(t + s + r).all():
                    return pd.DataFrame({"trend": t, "seasonal": s, "residual": r, "method": m, "period": p, "status": "success", "message": why or ""})
                why = why or f"{m}: not finite"
            except (ArithmeticError, ValueError, np.linalg.LinAlgError) as e:
                why = why or f"{m}: {type(e).__name__}: {e}"
        t = np.full(len(x), x.mean())
        return pd.DataFrame({"trend": t, "seasonal": np.zeros(len(x)), "residual": x - t, "method": "mean", "period": p, "status": "error", "message": why})

    return rows


def choose_method(x: np.ndarray, period: int) -> str:
    if len(x) < 2 * period + 2:
        return "fourier" if len(x) < 50 else "ssa"
    noise = np.std(np.diff(x, 2)) / max(np.std(x), 1e-12)
    return "robust_stl" if noise > 0.5 or K.stationarity(x)["is_stationary"] else "stl"


def run_method(x: np.ndarray, method: str, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if method == "stl":
        return K.stl(x, period)
    if method == "robust_stl":
        return K.robust_stl(x, period)
    if method == "mstl":
        t, s, r = K.mstl(x, sorted({period, *(p for p in detect(x)["periods"] if p >= 2)})[:3])
        return t, s.sum(axis=0), r
    if method == "fourier":
        return K.fourier(x, period)[:3]
    if method == "ssa":
        return K.ssa(x, period)
    if method == "smoothed":
        return K.smoothed_trend(x, period)
    if method == "additive_regression":
        return K.ridge_seasonal(x, [float(period)], [max(1, min(10, period // 2))])
    raise ValueError(f"no method {method!r}")


def detect(x: np.ndarray) -> dict:
    return K.period_consensus({"acf": K.acf_periods(x), "spectral": K.spectral_periods(x), "wavelet": K.wavelet_periods(x)})


def _pairs(rows: list[tuple[int, float]]) -> dict:
    rows = sorted(rows, key=lambda r: (-r[1], r[0]))[:10]
    return {"periods": [int(p) for p, _ in rows], "confidences": [float(c) for _, c in rows]}


def replace_outliers(df: DataFrame, value: str, method: str, most: float = 0.3) -> DataFrame:
    """``is_outlier`` and ``cleaned`` by isolation forest or LOF; outliers give way to the inliers' median, at most ``most``."""

    def rows(x: np.ndarray) -> pd.DataFrame:
        known = np.isfinite(x)
        mask, score = np.zeros(len(x), bool), np.full(len(x), np.nan)
        if known.sum() >= 10:
            v = x[known]
            score[known] = K.isolation_scores(v) if method == "isolation_forest" else K.lof(v, min(20, max(5, len(v) // 20)))
            q1, q3 = np.quantile(v, (0.25, 0.75))
            share = min(most, float(((v < q1 - 1.5 * (q3 - q1)) | (v > q3 + 1.5 * (q3 - q1))).mean()))
            k = int(round(share * len(v)))
            if k:
                mask[np.flatnonzero(known)[np.argsort(-score[known], kind="stable")[:k]]] = True
        clean = x.copy()
        if mask.any():
            clean[mask] = np.median(x[known & ~mask])
        return pd.DataFrame({"is_outlier": mask, "score": score, "cleaned": clean})

    return _grouped(df, value, "is_outlier boolean, score double, cleaned double", rows, True)


_PERIODS = "periods array<int>, confidences array<double>"
register_kernel("stationarity", K.stationarity, "adf_stat double, adf_p double, kpss_stat double, kpss_p double, mean_cv double, std_cv double, score double, is_stationary boolean")
register_kernel("acf", lambda x: {"acf": K.acf(x, min(50, len(x) // 3)).tolist()}, "acf array<double>")
register_kernel("acf_periods", lambda x: _pairs(K.acf_periods(x)), _PERIODS)
register_kernel("spectral_periods", lambda x: _pairs(K.spectral_periods(x)), _PERIODS)
register_kernel("wavelet_periods", lambda x: _pairs(K.wavelet_periods(x)), _PERIODS)
register_kernel("periodicity", lambda x: (d := detect(x)) | {"detection": d["status"]}, "period int, confidence double, strength double, detection string, periods array<int>")
register_kernel("whiteness", lambda x: {"ljung_box_p": K.ljung_box(x)}, "ljung_box_p double")
register_kernel("boxcox", lambda x: dict(zip(("lam", "shift"), K.boxcox_fit(x), strict=True)), "lam double, shift double")
register_kernel("canonical", lambda x: {"features": K.canonical(x)}, "features map<string,double>")
register_kernel("shape", lambda x: {"qq_correlation": K.qq_correlation(x), "is_multimodal": K.is_multimodal(x)}, "qq_correlation double, is_multimodal boolean")
register_kernel("legacy_period", lambda x: {"period": K.legacy_period(x)}, "period int")
register_kernel("smoothing_search", lambda x: dict(zip(("alpha", "smape"), K.smoothing_search(x), strict=True)), "alpha double, smape double")
