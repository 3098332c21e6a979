"""Group correction in plain numpy, to check the Spark routes against."""

import math
from statistics import NormalDist

import numpy as np


def midpoint(sample, i, n):
    at = i * (len(sample) - 1)
    return (sample[at // (n + 1)] + sample[-(-at // (n + 1))]) / 2


def knots(values, n):
    """Distinct midpoint quantiles and the smallest probability of each."""
    q = np.array([midpoint(values, i, n) for i in range(1, n + 1)])
    first = [k for k in range(n) if k == 0 or q[k] != q[k - 1]]
    return q[first], (np.array(first) + 1) / (n + 1)


def value_at(p, q, rank):
    return float(np.interp(rank, p, q, left=np.nan, right=np.nan))


def correct(pred, obs, mdl, params, precip=False, draws=None):
    """List of corrected members; None or NaN is missing."""
    obs = np.array([np.nan if v is None else v for v in obs], float)
    mdl = np.array([np.nan if v is None else v for v in mdl], float)
    have_o, have_m = np.sort(obs[~np.isnan(obs)]), np.sort(mdl[~np.isnan(mdl)])
    if not len(have_o) or not len(have_m):
        return [None] * len(pred)
    kinds = [len(set(h)) + int(len(h) < len(a)) for h, a in ((have_o, obs), (have_m, mdl))]
    if min(kinds) <= 10:
        return [float(have_o.mean())] * len(pred)
    n = len(obs)
    q_mdl, p_mdl = knots(have_m, params.nquants)
    q_obs, p_obs = knots(have_o, n)
    dry_obs = np.sum(have_o < params.dry_thresh) / n
    dry_mdl = np.sum(have_m < params.dry_thresh) / len(mdl)

    def tail(rule, c, rank, i):
        whole_o, whole_m = len(have_o) == n, len(have_m) == len(mdl)
        if rule == "constant":
            return (have_o[-1] if i == n else have_o[0]) if whole_o else np.nan
        if rule == "distribution":
            if precip and i == 1:
                return np.nan
            return have_o.mean() + have_o.std() * NormalDist().inv_cdf(rank) if whole_o else np.nan
        if not (whole_o and whole_m):
            return np.nan
        o, m = midpoint(have_o, i, n), midpoint(have_m, i, n)
        return c + (o - m) if rule == "delta_additive" else (c * o / m if m else np.nan)

    out = []
    for k, v in enumerate(pred):
        if v is None or math.isnan(v):
            out.append(None)
            continue
        c = min(max(v, q_mdl[0]), q_mdl[-1])
        rank = float(np.interp(c, q_mdl, p_mdl))
        value = value_at(p_obs, q_obs, rank)
        wet = c > 0 or not precip
        if wet and rank > n / (n + 1):
            value = tail(params.up_extrapol, c, rank, n)
        if wet and rank < 1 / (n + 1):
            value = tail(params.low_extrapol, c, rank, 1)
        if precip:
            if rank <= dry_obs:
                value = 0.0
            if params.intermittency and c < params.dry_thresh:
                if dry_obs >= dry_mdl:
                    value = 0.0
                else:
                    u = dry_mdl * draws[k]
                    value = 0.0 if u <= dry_obs else value_at(p_obs, q_obs, u)
        out.append(None if math.isnan(value) else float(value))
    return out
