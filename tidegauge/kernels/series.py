"""Numeric kernels for one series: NumPy arrays in, plain numbers and arrays out. No Spark here."""

from __future__ import annotations

import math

import numpy as np

# --- distributions ---------------------------------------------------------------------------------------------------


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def _gamma_p(a: float, x: float) -> float:
    """Regularised lower incomplete gamma by series or continued fraction."""
    if x <= 0:
        return 0.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-15:
            k += 1
            term *= x / k
            total += term
        return total * front
    b, c = x + 1 - a, 1e300
    d = h = 1 / b
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return 1 - front * h


def chi2_sf(x: float, df: float) -> float:
    return 1 - _gamma_p(df / 2, x / 2)


def _beta_fraction(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or 1e-300)
    h = d
    for m in range(1, 300):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + num * d or 1e-300)
            c = 1 + num / c or 1e-300
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def beta_cdf(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def t_two_sided(t: float, df: float) -> float:
    return beta_cdf(df / 2, 0.5, df / (df + t * t))


def correlation_p(r: float, n: int) -> float:
    if n < 3 or abs(r) >= 1:
        return 0.0 if n >= 3 else 1.0
    return t_two_sided(r * math.sqrt((n - 2) / (1 - r * r)), n - 2)


# --- autocorrelation and stationarity --------------------------------------------------------------------------------


def acf(x: np.ndarray, lags: int, adjusted: bool = True) -> np.ndarray:
    """Autocorrelations from lag 0, by FFT."""
    x = x - x.mean()
    n = len(x)
    size = 1 << (2 * n - 1).bit_length()
    c = np.fft.irfft(np.abs(np.fft.rfft(x, size)) ** 2)[: lags + 1]
    if adjusted:
        c = c / (n - np.arange(lags + 1))
    return c / c[0] if c[0] > 0 else np.r_[1.0, np.zeros(lags)]


def ljung_box(x: np.ndarray, lags: int = 10) -> float:
    """The least p-value over the first lags."""
    n = len(x)
    lags = min(lags, max(1, n // 5))
    r = acf(x, lags, adjusted=False)[1:]
    q = n * (n + 2) * np.cumsum(r**2 / (n - np.arange(1, lags + 1)))
    return min(chi2_sf(float(v), k) for k, v in enumerate(q, 1))


def _ols(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    e = y - x @ beta
    s2 = e @ e / max(1, len(y) - x.shape[1])
    return beta, np.sqrt(np.maximum(np.diag(np.linalg.pinv(x.T @ x)) * s2, 0)), float(e @ e)


def adf(x: np.ndarray) -> tuple[float, float, int]:
    """Augmented Dickey-Fuller statistic with constant, p-value, and the lag that AIC picks."""
    n = len(x)
    top = min(int(math.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)
    d = np.diff(x)

    def design(lag: int, first: int):
        y = d[first:]
        cols = [x[first:-1], np.ones(len(y))] + [d[first - k : len(d) - k] for k in range(1, lag + 1)]
        return y, np.stack(cols, axis=1)

    best = (np.inf, 0)
    for lag in range(max(0, top) + 1):
        y, m = design(lag, top)
        _, _, rss = _ols(y, m)
        best = min(best, (len(y) * math.log(max(rss, 1e-300) / len(y)) + 2 * m.shape[1], lag))
    y, m = design(best[1], best[1])
    beta, se, _ = _ols(y, m)
    stat = float(beta[0] / se[0]) if se[0] > 0 else 0.0
    return stat, mackinnon_p(stat), best[1]


def mackinnon_p(t: float) -> float:
    """Approximate p-value of the test with constant and one series."""
    # Published response-surface coefficients.
    if t > 2.74:
        return 1.0
    if t < -18.83:
        return 0.0
    c = (2.1659, 1.4412, 0.038269) if t <= -1.61 else (1.7339, 0.93202, -0.12745, -0.010368)
    return normal_cdf(sum(v * t**k for k, v in enumerate(c)))


def kpss(x: np.ndarray) -> tuple[float, float]:
    """Level statistic with automatic bandwidth, and the p-value from the table, within 0.01 and 0.1."""
    n = len(x)
    e = x - x.mean()
    top = int(n ** (2 / 9))
    s0, s1 = e @ e / n, 0.0
    for i in range(1, top + 1):
        p = 2 * (e[i:] @ e[:-i]) / n
        s0, s1 = s0 + p, s1 + i * p
    gamma = 1.1447 * ((s1 / s0) ** 2) ** (1 / 3) if s0 else 0.0
    lags = min(int(gamma * n ** (1 / 3)), n - 1)
    long = e @ e / n + 2 / n * sum((e[i:] @ e[:-i]) * (1 - i / (lags + 1)) for i in range(1, lags + 1))
    stat = float((np.cumsum(e) ** 2).sum() / (n * n * long)) if long > 0 else 0.0
    # Critical values.
    return stat, float(np.interp(stat, (0.347, 0.463, 0.574, 0.739), (0.10, 0.05, 0.025, 0.01)))


def rolling_stability(x: np.ndarray, ratio: float = 0.1, least: int = 30) -> tuple[float, float]:
    """Coefficients of variation of the rolling mean and deviation."""
    n = len(x)
    w = min(max(least, int(min(ratio * n, n / 3))), max(3, n // 3))
    if n < w or w < 2:
        return 0.0, 0.0
    v = np.lib.stride_tricks.sliding_window_view(x, w)
    m, s = v.mean(axis=1), v.std(axis=1, ddof=1)
    cv = lambda a: float(a.std(ddof=1) / abs(a.mean())) if len(a) > 1 and a.mean() else 0.0
    return cv(m), cv(s)


def stationarity(x: np.ndarray, alpha: float = 0.05, rolling_limit: float = 0.2) -> dict:
    """Weighted vote of both tests and the rolling stability."""
    if len(x) < 12 or x.std() < 1e-10:
        constant = len(x) > 0 and x.std() < 1e-10
        return {"adf_stat": None, "adf_p": None, "kpss_stat": None, "kpss_p": None, "mean_cv": 0.0, "std_cv": 0.0, "score": float(constant), "is_stationary": bool(constant)}
    a, ap, _ = adf(x)
    k, kp = kpss(x)
    m, s = rolling_stability(x)
    score = 0.4 * (ap < alpha) + 0.4 * (kp > alpha) + 0.2 * (max(m, s) < rolling_limit)
    return {"adf_stat": a, "adf_p": ap, "kpss_stat": k, "kpss_p": kp, "mean_cv": m, "std_cv": s, "score": float(score), "is_stationary": bool(score >= 0.5)}


# --- peaks and periods -----------------------------------------------------------------------------------------------


def find_peaks(x: np.ndarray, height: float = -np.inf, prominence: float = 0.0, distance: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Local maxima (the middle of plateaus) with their prominences; the higher one stays where two are too near."""
    peaks, i, n = [], 1, len(x)
    while i < n - 1:
        if x[i] > x[i - 1]:
            j = i
            while j < n - 1 and x[j + 1] == x[i]:
                j += 1
            if j < n - 1 and x[j + 1] < x[i]:
                peaks.append((i + j) // 2)
            i = j + 1
        else:
            i += 1
    p = np.array([k for k in peaks if x[k] >= height], np.int64)
    if distance > 1 and len(p):
        keep = np.ones(len(p), bool)
        for k in np.argsort(x[p], kind="stable")[::-1]:
            if keep[k]:
                keep &= (np.abs(p - p[k]) >= distance) | (p == p[k])
        p = p[keep]
    prom = []
    for k in p:
        left, right = np.flatnonzero(x[:k] > x[k]), np.flatnonzero(x[k + 1 :] > x[k])
        a = left[-1] if len(left) else 0
        b = k + 1 + right[0] if len(right) else n - 1
        prom.append(x[k] - max(x[a : k + 1].min(), x[k : b + 1].min()))
    prom = np.array(prom)
    good = prom >= prominence if len(p) else np.zeros(0, bool)
    return p[good], prom[good]


def detrend(x: np.ndarray) -> np.ndarray:
    t = np.arange(len(x)) - (len(x) - 1) / 2
    return x - x.mean() - t * (t @ x / (t @ t))


def _max_period(n: int) -> int:
    return n // 3 if n < 100 else min(n // 3, 300) if n < 1000 else min(n // 4, 500)


def _trust(period: int, confidence: float, n: int) -> float:
    c = confidence * (0.7 if period < 3 else 1)
    if period / n > 0.5:
        c *= 1.5 - period / n
    return min(1.0, c * (0.8 if n / period < 2 else 1))


def acf_periods(x: np.ndarray) -> list[tuple[int, float]]:
    n = len(x)
    lags = max(min(int(0.5 * n), _max_period(n), 1000), 10)
    if n < 12 or x.std() < 1e-10:
        return []
    a = acf(detrend(x), min(lags, n - 2))
    limit = min(0.5, max(0.05, 1.96 / math.sqrt(n)))
    p, prom = find_peaks(a, height=limit, prominence=0.1, distance=2)
    return [(int(k), _trust(int(k), float(a[k]) * min(1, q / 0.2), n)) for k, q in zip(p, prom, strict=True) if k >= 2]


def welch(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and mean power of half-overlapping Hann segments."""
    n = len(x)
    size = min(512, 1 << max(3, int(math.log2(max(8, n / 4))))) if n >= 32 else n
    w = np.hanning(size + 1)[:-1]
    starts = range(0, n - size + 1, max(1, size // 2))
    power = np.mean([np.abs(np.fft.rfft((x[s : s + size] - x[s : s + size].mean()) * w, 4 * size)) ** 2 for s in starts], axis=0)
    return np.fft.rfftfreq(4 * size), power / max(power.sum(), 1e-300)


def spectral_periods(x: np.ndarray, top: int = 5) -> list[tuple[int, float]]:
    n = len(x)
    if n < 12 or x.std() < 1e-10:
        return []
    f, p = welch(detrend(x))
    peaks, _ = find_peaks(p, height=0.2 * p.max(), prominence=0.06 * p.max())
    out: dict[int, float] = {}
    for k in peaks[np.argsort(-p[peaks])][:top]:
        a, b, c = np.log(p[k - 1 : k + 2] + 1e-300)
        raw = 1 / (f[1] * (k + 0.5 * (a - c) / (a - 2 * b + c)))  # the vertex of the parabola through the peak
        period = round(raw)
        if 2 <= period <= _max_period(n):
            penalty = 1 - min(3 * abs(raw - period) / period, 0.7)
            out[period] = max(out.get(period, 0), _trust(period, float(p[k] / p.max()) * penalty, n))
    return list(out.items())


def wavelet_periods(x: np.ndarray, scales: int = 100, top: int = 5) -> list[tuple[int, float]]:
    """Peaks of the mean power over scales of a complex Morlet transform (bandwidth 1.5, centre 1)."""
    n = len(x)
    if n < 24 or x.std() < 1e-10:
        return []
    z = np.fft.fft((x - x.mean()) / x.std(), 1 << (2 * n - 1).bit_length())
    freq = np.fft.fftfreq(len(z))
    period = np.geomspace(2, max(3, _max_period(n)), scales)
    power = np.array([np.mean(np.abs(np.fft.ifft(z * np.exp(-(math.pi**2) * 1.5 * (s * freq - 1) ** 2))[:n]) ** 2) for s in period])
    peaks, prom = find_peaks(power, height=0.2 * power.max(), prominence=0.3 * 0.2 * power.max())
    out: dict[int, float] = {}
    for k in peaks[np.argsort(-power[peaks])][:top]:
        p = round(float(period[k]))
        err = abs(period[k] - p) / p
        out[p] = max(out.get(p, 0), _trust(p, float(power[k] / power.max()) * max(0.5, 1 - 2 * err), n))
    return list(out.items())


def period_consensus(found: dict[str, list[tuple[int, float]]]) -> dict:
    """Groups of near periods, judged by confidence and by how many methods agree; the best one's status."""
    flat = sorted((p, c, m) for m, rows in found.items() for p, c in rows)
    groups: list[list] = []
    for p, c, m in flat:
        width = 0.05 if p < 10 else 0.08 if p < 50 else 0.10
        if groups and p - groups[-1][-1][0] <= width * p:
            groups[-1].append((p, c, m))
        else:
            groups.append([(p, c, m)])
    rated = []
    for g in groups:
        c = np.array([x[1] for x in g])
        methods = len({x[2] for x in g})
        period = round(sum(x[0] * x[1] for x in g) / max(c.sum(), 1e-12))
        confidence = min(1.0, float(c.mean()) * (1 + 0.15 * (methods - 1)))
        rated.append((confidence * min(1, methods / 3) * max(0.5, 1 - float(c.std())), period, confidence, min(1, methods / 3) * max(0.5, 1 - float(c.std())), methods))
    rated.sort(key=lambda r: (-r[0], r[1]))
    best = next((r for r in rated if r[3] >= 0.3 and not (r[4] == 1 and r[2] < 0.8)), None)
    if best is None:
        return {"period": 0, "confidence": 0.0, "strength": 0.0, "status": "not_detected", "periods": [r[1] for r in rated[:10]]}
    conf = [c for _, c, _ in flat]
    check = 0.6 * (1 - min(1.0, float(np.std(conf)))) + 0.4 * float(np.mean(conf)) if len(conf) > 1 else 0.5
    score = 0.4 * best[2] + 0.4 * best[3] + 0.2 * check
    status = "high_confidence" if score >= 0.75 else "detected" if score >= 0.55 else "low_confidence" if score >= 0.35 else "spurious"
    return {"period": int(best[1]), "confidence": best[2], "strength": best[3], "status": status, "periods": [r[1] for r in rated[:10]]}


# --- decomposition ---------------------------------------------------------------------------------------------------


def _moving(x: np.ndarray, n: int) -> np.ndarray:
    c = np.cumsum(np.r_[0.0, x])
    return (c[n:] - c[:-n]) / n


def loess(y: np.ndarray, q: int, degree: int = 1, weight: np.ndarray | None = None, at: np.ndarray | None = None) -> np.ndarray:
    """Local regression with tricube weights over the q nearest points of an evenly spaced series, at given places."""
    n = len(y)
    at = np.arange(n, dtype=float) if at is None else at
    w = np.ones(n) if weight is None else weight
    span = min(q, n)
    left = np.clip(np.round(at).astype(int) - span // 2, 0, n - span)
    idx = left[:, None] + np.arange(span)
    d = np.abs(idx - at[:, None])
    reach = np.maximum(at - left, left + span - 1 - at)[:, None] + (max(0, q - n) // 2) + 1e-12
    k = (1 - np.minimum(d / (reach * 1.0001), 1) ** 3) ** 3 * w[idx]
    total = k.sum(axis=1)
    k = np.where(total[:, None] > 0, k / np.where(total > 0, total, 1)[:, None], 1 / span)
    yy = y[idx]
    mean = (k * yy).sum(axis=1)
    if degree == 0:
        return mean
    xm = (k * idx).sum(axis=1)
    dx = idx - xm[:, None]
    var = (k * dx * dx).sum(axis=1)
    slope = np.where(var > 1e-12, (k * dx * yy).sum(axis=1) / np.where(var > 1e-12, var, 1), 0)
    return mean + slope * (at - xm)


def _odd(x: float) -> int:
    n = int(math.ceil(x))
    return n + 1 - n % 2


def stl(y: np.ndarray, period: int, seasonal: int = 7, trend: int | None = None, robust: bool = False, inner: int = 2, outer: int = 5) -> tuple[np.ndarray, ...]:
    """Seasonal-trend decomposition by local regression: ``trend, seasonal, residual``."""
    n = len(y)
    trend_n = _odd(trend or 1.5 * period / (1 - 1.5 / seasonal))
    low = _odd(period)
    t, s, w = np.zeros(n), np.zeros(n), np.ones(n)
    for _ in range(outer if robust else 1):
        for _ in range(inner):
            c = np.empty(n + 2 * period)
            for k in range(period):
                sub = (y - t)[k::period]
                at = np.arange(-1, len(sub) + 1, dtype=float)
                c[k :: period][: len(at)] = loess(sub, seasonal, 1, w[k::period], at)
            smooth = loess(_moving(_moving(_moving(c, period), period), 3), low)
            s = c[period : period + n] - smooth[:n]
            t = loess(y - s, trend_n, 1, w)
        r = y - t - s
        if robust:
            h = 6 * np.median(np.abs(r))
            w = (1 - np.minimum(np.abs(r) / h, 1) ** 2) ** 2 if h > 0 else np.ones(n)
    return t, s, y - t - s


def robust_stl(y: np.ndarray, period: int, threshold: float = 2.5, rounds: int = 5, gain: float = 0.01) -> tuple[np.ndarray, ...]:
    """STL again and again on data whose residual outliers gave way to trend and season, until that stops helping."""
    now, before = y.copy(), np.inf
    for _ in range(rounds):
        t, s, _ = stl(now, period, robust=True)
        r = y - t - s
        sd = float(np.std(now - t - s))
        far = np.abs(r - np.median(r)) > threshold * max(1.4826 * np.median(np.abs(r - np.median(r))), 1e-12)
        if before - sd < gain * max(sd, 1e-12) or not far.any():
            break
        before = sd
        now = np.where(far, t + s, y)
    return t, s, y - t - s


def mstl(y: np.ndarray, periods: list[int], rounds: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One season for each period, fitted in turn: ``trend, seasons, residual``."""
    periods = [p for p in sorted(periods) if 2 * p <= len(y)]
    seasons = np.zeros((len(periods), len(y)))
    t = np.zeros(len(y))
    for _ in range(rounds):
        for k, p in enumerate(periods):
            rest = y - seasons.sum(axis=0) + seasons[k]
            t, seasons[k], _ = stl(rest, p, seasonal=7 + 4 * (k + 1))
    return t, seasons, y - t - seasons.sum(axis=0)


def fourier(y: np.ndarray, period: int, harmonics: int = 10) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Linear trend and the strongest harmonics: ``trend, seasonal, residual, spectral entropy``."""
    n = len(y)
    d = detrend(y)
    spec = np.fft.rfft(d)
    power = np.abs(spec) ** 2
    peaks, _ = find_peaks(np.r_[0.0, power[1:], 0.0], height=0.05 * power[1:].max() if n > 2 else 0)
    count = max(1, min(harmonics, period // 2 or 1, n // 4))
    top = peaks[np.argsort(-power[peaks], kind="stable")][:count]
    kept = np.zeros_like(spec)
    kept[top] = spec[top]
    s = np.fft.irfft(kept, n)
    p = power[1:] / max(power[1:].sum(), 1e-300)
    entropy = float(-(p * np.log2(p + 1e-300)).sum() / math.log2(len(p))) if len(p) > 1 else 0.0
    return y - d, s, d - s, entropy


def ssa(y: np.ndarray, period: int, variance: float = 0.85, most: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Singular spectrum analysis: the first component is the trend, the rest up to the variance wanted the season."""
    n = len(y)
    w = min(2 * period, n // 2) if period > 2 else n // 3
    w = max(5, min(w, n // 2))
    mean = y.mean()
    x = np.lib.stride_tricks.sliding_window_view(y - mean, w).T
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    share = np.cumsum(s**2) / max((s**2).sum(), 1e-300)
    k = min(max(3, int(np.searchsorted(share, variance)) + 1), most, len(s))
    anti = (np.arange(x.shape[0])[:, None] + np.arange(x.shape[1])).ravel()
    weight = np.bincount(anti, minlength=n)
    part = lambda a: np.bincount(anti, a.ravel(), n) / weight
    low = [i for i in range(k) if np.abs(np.diff(np.signbit(u[:, i]).astype(int))).sum() <= 1] or [0]
    t = mean + sum(part(s[i] * np.outer(u[:, i], vt[i])) for i in low)
    season = sum((part(s[i] * np.outer(u[:, i], vt[i])) for i in range(k) if i not in low), np.zeros(n))
    return t, season, y - t - season


def ridge_seasonal(y: np.ndarray, periods: list[float], orders: list[int], changepoints: int = 25, penalty: float = 1.0) -> tuple[np.ndarray, ...]:
    """Piecewise-linear trend and Fourier seasons by ridge regression: ``trend, seasonal, residual``."""
    n = len(y)
    t = np.arange(n) / max(1, n - 1)
    knots = np.linspace(0, 0.8, min(changepoints, max(1, n // 5)) + 1)[1:]
    trend = np.column_stack([np.ones(n), t, *(np.maximum(0, t - k) for k in knots)])
    waves = [f(2 * math.pi * j * np.arange(n) / p) for p, m in zip(periods, orders, strict=True) for j in range(1, m + 1) for f in (np.sin, np.cos)]
    x = np.column_stack([trend, *waves])
    reg = np.r_[0, 0, np.full(x.shape[1] - 2, penalty)]
    scale = max(float(np.std(y)), 1e-12)
    beta = np.linalg.solve(x.T @ x + np.diag(reg + 1e-9), x.T @ (y / scale)) * scale
    a = trend @ beta[: trend.shape[1]]
    s = x[:, trend.shape[1] :] @ beta[trend.shape[1] :]
    return a, s, y - a - s


# --- Box-Cox, outliers -----------------------------------------------------------------------------------------------


def boxcox(x: np.ndarray, lam: float) -> np.ndarray:
    return np.log(x) if abs(lam) < 1e-8 else (x**lam - 1) / lam


def boxcox_inverse(z: np.ndarray, lam: float) -> np.ndarray:
    return np.exp(z) if abs(lam) < 1e-8 else np.maximum(z * lam + 1, 1e-12) ** (1 / lam)


def boxcox_fit(x: np.ndarray) -> tuple[float, float]:
    """Maximum-likelihood lambda in [-2, 2] by golden section, and the shift that makes the data positive."""
    shift = max(0.0, 1e-6 + 1e-3 * float(np.ptp(x)) - float(x.min())) if x.min() <= 0 else 0.0
    y = x + shift
    logs = np.log(y).sum()
    cost = lambda lam: 0.5 * len(y) * math.log(max(float(np.var(boxcox(y, lam))), 1e-300)) - (lam - 1) * logs
    a, b, g = -2.0, 2.0, (math.sqrt(5) - 1) / 2
    c, d = b - g * (b - a), a + g * (b - a)
    fc, fd = cost(c), cost(d)
    while b - a > 1e-6:
        if fc < fd:
            b, d, fd = d, c, fc
            c = b - g * (b - a)
            fc = cost(c)
        else:
            a, c, fc = c, d, fd
            d = a + g * (b - a)
            fd = cost(d)
    return (a + b) / 2, shift


def lof(x: np.ndarray, k: int) -> np.ndarray:
    """Local outlier factors of single values, from the k nearest in sorted order."""
    n = len(x)
    k = min(k, n - 1)
    order = np.argsort(x, kind="stable")
    v = x[order]
    left = np.clip(np.arange(n) - k, 0, None)
    near, dist = np.empty((n, k), int), np.empty((n, k))
    for i in range(n):
        j = np.r_[np.arange(left[i], i), np.arange(i + 1, min(n, i + k + 1))]
        d = np.abs(v[j] - v[i])
        top = np.argsort(d, kind="stable")[:k]
        near[i], dist[i] = j[top], d[top]
    far = dist[:, -1]
    density = 1 / np.maximum(np.maximum(dist, far[near]).mean(axis=1), 1e-10)
    out = np.empty(n)
    out[order] = density[near].mean(axis=1) / density
    return out


def isolation_scores(x: np.ndarray, trees: int = 100, size: int = 256, seed: int = 42) -> np.ndarray:
    """Isolation-forest scores of single values; near 1 is anomalous. The seed is fixed."""
    rng = np.random.default_rng(seed)
    size = min(size, len(x))
    limit = math.ceil(math.log2(max(size, 2)))
    path = lambda n: 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
    total = np.zeros(len(x))

    def grow(sample: np.ndarray, who: np.ndarray, depth: int) -> None:
        if depth >= limit or len(sample) < 2 or sample.min() == sample.max():
            total[who] += depth + path(len(sample))
            return
        cut = rng.uniform(sample.min(), sample.max())
        grow(sample[sample < cut], who[x[who] < cut], depth + 1)
        grow(sample[sample >= cut], who[x[who] >= cut], depth + 1)

    for _ in range(trees):
        grow(rng.choice(x, size, replace=False), np.arange(len(x)), 0)
    return 2 ** (-total / trees / max(path(size), 1e-9))


# --- canonical features ----------------------------------------------------------------------------------------------


def canonical(x: np.ndarray) -> dict[str, float]:
    """A selection of the canonical time-series characteristics, from their published definitions, on the z-scored series."""
    n = len(x)
    sd = x.std(ddof=1) if n > 1 else 0.0
    if n < 10 or sd < 1e-12:
        return {}
    z = (x - x.mean()) / sd

    def mode(bins: int) -> float:
        h, e = np.histogram(z, bins)
        return float(np.mean([(e[i] + e[i + 1]) / 2 for i in np.flatnonzero(h == h.max())]))

    a = acf(z, n - 1, adjusted=False)
    below, dips = np.flatnonzero(a < 1 / math.e), np.flatnonzero((a[1:-1] < a[:-2]) & (a[1:-1] < a[2:]))
    d = np.diff(z)
    third = np.digitize(z, np.quantile(z, (1 / 3, 2 / 3)))
    pairs = np.bincount(third[:-1] * 3 + third[1:], minlength=9) / (n - 1)
    long = lambda m: max((len(r) for r in "".join("1" if v else "0" for v in m).split("0")), default=0)
    mean3 = (z[:-3] + z[1:-2] + z[2:-1]) / 3
    f, p = np.fft.rfftfreq(n), np.abs(np.fft.rfft(z)) ** 2
    tau = int(below[0]) if len(below) else n - 1
    coarse = np.digitize(z[:: max(1, tau)], np.quantile(z[:: max(1, tau)], (1 / 3, 2 / 3)))
    m = np.zeros((3, 3))
    np.add.at(m, (coarse[:-1], coarse[1:]), 1)
    m /= np.maximum(m.sum(axis=1, keepdims=True), 1)
    gauss = [-0.5 * math.log(max(1 - v * v, 1e-12)) for v in a[1 : min(41, n // 2)]]
    ami = next((i + 1 for i in range(1, len(gauss) - 1) if gauss[i] < gauss[i - 1] and gauss[i] < gauss[i + 1]), len(gauss))
    lag = max(1, tau)
    dist = np.sqrt(np.diff(z[:-lag]) ** 2 + np.diff(z[lag:]) ** 2) if n > lag + 1 else np.zeros(1)
    sizes = np.unique(np.geomspace(5, max(6, n // 2), 20).astype(int))
    walk = np.cumsum(z)
    fluct = []
    for s in sizes:
        k = n // s
        w = walk[: k * s].reshape(k, s)
        t = np.arange(s) - (s - 1) / 2
        fluct.append(math.sqrt(np.mean((w - w.mean(axis=1, keepdims=True) - np.outer(w @ t / (t @ t), t)) ** 2)))
    slope = np.polyfit(np.log(sizes), np.log(np.maximum(fluct, 1e-12)), 1)[0] if len(sizes) > 2 else 0.0
    return {
        "c22_mode_5": mode(5), "c22_mode_10": mode(10), "c22_acf_timescale": float(tau), "c22_acf_first_min": float(dips[0] + 1) if len(dips) else float(n),
        "c22_ami_timescale": float(ami), "c22_entropy_pairs": float(-(pairs[pairs > 0] * np.log(pairs[pairs > 0])).sum()), "c22_high_fluctuation": float((np.abs(d) > 0.04).mean()),
        "c22_trev": float((d**3).mean()), "c22_stretch_high": float(long(z > 0)), "c22_stretch_decreasing": float(long(d < 0)), "c22_forecast_error": float(np.std(z[3:] - mean3, ddof=1)),
        "c22_centroid_freq": float(f[np.searchsorted(np.cumsum(p), p.sum() / 2)] * 2 * math.pi), "c22_low_freq_power": float(p[: max(1, len(p) // 5)].sum() / max(p.sum(), 1e-300)),
        "c22_embedding_dist": float(dist.std(ddof=1) / max(dist.mean(), 1e-12)) if len(dist) > 1 else 0.0, "c22_transition_variance": float(np.trace(np.cov(m.T))), "c22_dfa": float(slope),
    }


# --- shape of the distribution, legacy period rules, smoothing -------------------------------------------------------


def qq_correlation(x: np.ndarray) -> float:
    """Correlation with the normal quantiles of the median ranks."""
    from statistics import NormalDist

    n = len(x)
    m = (np.arange(1, n + 1) - 0.3175) / (n + 0.365)
    m[-1] = 0.5 ** (1 / n)
    m[0] = 1 - m[-1]
    return float(np.corrcoef(np.sort(x), [NormalDist().inv_cdf(v) for v in m])[0, 1])


def is_multimodal(x: np.ndarray) -> bool:
    """More than one prominent peak in the histogram."""
    h, _ = np.histogram(x, bins="auto")
    return len(find_peaks(np.r_[0, h, 0].astype(float), prominence=0.1 * h.max())[0]) > 1


def legacy_period(x: np.ndarray) -> int:
    """The lesser of the first lag with autocorrelation over 0.3 and the strongest frequency's period, two at least."""
    a = acf(x, min(len(x) - 1, 365), adjusted=False)
    over = np.flatnonzero(a[1:] > 0.3)
    p = np.abs(np.fft.rfft(x - x.mean())) ** 2
    k = int(np.argmax(p[1:])) + 1
    return max(2, min(int(over[0]) + 1 if len(over) else len(x), round(len(x) / k)))


def smoothing_search(x: np.ndarray, grid=tuple(i / 20 for i in range(1, 20))) -> tuple[float, float]:
    """The exponential-smoothing weight with the least sMAPE of one-step forecasts, and that sMAPE."""
    best = (float("inf"), 0.0)
    for a in grid:
        level, total = x[0], 0.0
        for v in x[1:]:
            both = abs(v) + abs(level)
            total += 2 * abs(v - level) / both if both else 0.0
            level += a * (v - level)
        best = min(best, (100 * total / (len(x) - 1), a))
    return best[1], best[0]


def smoothed_trend(y: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trend by a uniform filter of one period, season by place in the period: what stands in for heavier models."""
    w = max(3, min(period, len(y) // 2))
    pad = np.pad(y, (w // 2, w - 1 - w // 2), mode="edge")
    t = _moving(pad, w)
    d = y - t
    k = np.arange(len(y)) % max(period, 1)
    s = np.array([d[k == i].mean() for i in range(max(period, 1))])[k] if period > 1 else np.zeros(len(y))
    s = s - s.mean()
    return t, s, y - t - s
