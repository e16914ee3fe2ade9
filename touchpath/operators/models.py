"""M1-M8: heuristic and Markov (removal-effect) attribution on the path table.

Input is ``model_paths`` output, or ``chain_weights`` of the chains themselves:
``chain`` (array of channels), ``nr_chains`` (weight) and ``total_revenue``
(value). Every model is linear in its paths, so chains need no grouping by path.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The pandas solver runs in Python workers; ship this module's code by value
# so workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Absorbing-chain state names.
START = "(start)"
CONVERSION = "(conversion)"


def chain_weights(chains: DataFrame) -> DataFrame:
    """Each chain as a path of weight 1 (0 without a customer, as paths count customers)."""
    return chains.select("chain", F.when(F.col("customer_id").isNotNull(), 1).otherwise(0).cast("bigint").alias("nr_chains"),
                         F.col("purchase_value").cast("double").alias("total_revenue"))


def heuristic_attribution(paths: DataFrame) -> DataFrame:
    """M1-M3 in one aggregation: first, last and linear touch credit per channel.

    Mono-touch paths give full first- and last-touch credit; linear credit is
    ``weight / len`` per position, repeated channels add up.
    """
    t = paths.select("nr_chains", "total_revenue", F.size("chain").alias("len"),
                     F.posexplode("chain").alias("pos", "channel_name"))
    n, v = F.col("nr_chains").cast("double"), F.col("total_revenue").cast("double")
    first, last = F.col("pos") == 0, F.col("pos") == F.col("len") - 1
    return t.groupBy("channel_name").agg(
        F.sum(F.when(first, n).otherwise(0.0)).alias("first_touch_conversions"),
        F.sum(F.when(first, v).otherwise(0.0)).alias("first_touch_value"),
        F.sum(F.when(last, n).otherwise(0.0)).alias("last_touch_conversions"),
        F.sum(F.when(last, v).otherwise(0.0)).alias("last_touch_value"),
        F.sum(n / F.col("len")).alias("linear_touch_conversions"),
        F.sum(v / F.col("len")).alias("linear_touch_value"),
    )


def markov_transitions(paths: DataFrame) -> DataFrame:
    """M4: weighted first-order transitions ``(start) -> c1 -> ... -> ck -> (conversion)``.

    Each path contributes its weight to every edge and its value to the final
    (conversion) edge. Self-transitions are kept (they do not change
    absorption probabilities).
    """
    states = F.concat(F.array(F.lit(START)), F.col("chain"), F.array(F.lit(CONVERSION)))
    p = paths.select(states.alias("s"), "nr_chains", F.col("total_revenue").cast("double").alias("v"))
    edges = p.select("nr_chains", "v", F.size("s").alias("len"), F.posexplode(
        F.transform(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.struct(
            F.element_at("s", i).alias("from_state"), F.element_at("s", i + 1).alias("to_state")))).alias("i", "e"))
    is_last = F.col("i") == F.col("len") - 2
    return edges.groupBy(F.col("e.from_state").alias("from_state"), F.col("e.to_state").alias("to_state")).agg(
        F.sum("nr_chains").cast("bigint").alias("nr_transitions"),
        F.sum(F.when(is_last, F.col("v")).otherwise(0.0)).alias("transition_value"),
    )


def markov_probabilities(transitions: DataFrame) -> DataFrame:
    """M5: row-normalised transition probabilities."""
    total = F.sum("nr_transitions").over(Window.partitionBy("from_state"))
    return transitions.select("from_state", "to_state", (F.col("nr_transitions") / total).alias("probability"))


EFFECTS = ["channel_name", "removal_effect_volume", "removal_effect_value", "markov_volume", "markov_value"]
_EFFECTS_SCHEMA = T.StructType([T.StructField(c, T.StringType() if c == "channel_name" else T.DoubleType()) for c in EFFECTS])


def _can_convert(edges: pd.DataFrame) -> set[str]:
    """States from which the conversion can be reached: without the others, ``I - Q`` has an inverse."""
    into = edges.groupby("to_state")["from_state"].agg(list).to_dict()
    found, work = set(), [CONVERSION]
    while work:
        for state in into.get(work.pop(), ()):
            if state not in found:
                found.add(state)
                work.append(state)
    return found


def _solve(edges: pd.DataFrame) -> pd.DataFrame:
    """Effects of all channels from one factorisation of ``I - Q``.

    With Q the transient-to-transient probabilities, r the probability of
    stepping to conversion and rv the conversion value per visit, ``f = G r``
    and ``g = G rv`` with ``G = (I - Q)^-1`` are conversion probability and
    expected value from each state. Removing a channel sends its visitors to the
    null state, which is a rank-one change: of the start's ``f``, the paths
    through channel k are ``G[start, k] / G[k, k] * f[k]`` (the chance to reach k
    times what follows), so no channel needs a solve of its own.
    """
    total = edges.groupby("from_state")["nr_transitions"].transform("sum")
    edges = edges.assign(p=edges["nr_transitions"] / total, v=edges["transition_value"] / total)
    channels = sorted(set(edges["from_state"]) - {START})
    kept = _can_convert(edges[edges["nr_transitions"] > 0]) | {START}
    states = {s: i for i, s in enumerate(sorted(kept))}
    ends = edges[edges["to_state"] == CONVERSION]
    inner = edges[edges["from_state"].isin(kept) & edges["to_state"].isin(kept - {CONVERSION})]
    at = lambda names: names.map(states).to_numpy()
    left, step = np.eye(len(states)), np.zeros((len(states), 2))
    np.subtract.at(left, (at(inner["from_state"]), at(inner["to_state"])), inner["p"].to_numpy())
    np.add.at(step, at(ends["from_state"]), ends[["p", "v"]].to_numpy())
    inverse = np.linalg.inv(left)
    found, start = inverse @ step, states[START]
    places = np.array([states.get(c, -1) for c in channels], int)
    lost = np.where(places[:, None] >= 0, (inverse[start, places] / np.diag(inverse)[places])[:, None] * found[places], 0.0)
    whole = found[start]
    effect = np.divide(lost, whole, out=np.zeros_like(lost), where=whole != 0)
    sums = effect.sum(axis=0)
    share = np.divide(effect, sums, out=np.zeros_like(effect), where=sums != 0) * ends[["nr_transitions", "transition_value"]].sum().to_numpy()
    return pd.DataFrame(dict(zip(EFFECTS, [channels, *effect.T, *share.T])))


def markov_removal_effects(transitions: DataFrame) -> DataFrame:
    """M6 + M7: removal effects and Markov attribution per channel.

    The data-sized work is M4's; what is solved here has one row per pair of
    states, whatever the number of paths (21 states with the classifier's
    labels). One task inverts a dense matrix of states squared, so a few
    thousand states are the limit.
    """
    return transitions.groupBy().applyInPandas(_solve, _EFFECTS_SCHEMA)


def markov_attribution(paths: DataFrame) -> DataFrame:
    """M7: ``channel_name, markov_volume, markov_value``."""
    return markov_removal_effects(markov_transitions(paths)).select("channel_name", "markov_volume", "markov_value")


def attribution_results(stats: DataFrame, markov: DataFrame, heuristics: DataFrame, run_date=None) -> DataFrame:
    """M8 (+ P12): channel statistics, Markov and heuristic results side by side.

    Each input has one row per channel (at most the classifier's 19), so the
    full outer joins are on tiny relations.
    """
    out = stats.join(markov, "channel_name", "full").join(heuristics, "channel_name", "full")
    return out if run_date is None else out.withColumn("_run_date", F.lit(run_date))
