"""Community analysis of a long taxon table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from brinedeck.operators.community import bray_curtis, community, env_fit_test, factor_fit, factor_fit_test, sqrt_transform, wisconsin


def dissimilarities(long: DataFrame, *, key: str, taxon: str, value: str, where: Column, transform: str = "auto") -> DataFrame:
    """Dissimilarity matrix of chosen samples; ``auto`` is the double standardisation, ``sqrt`` the root only."""
    rows = community(long, taxon=taxon, value=value, where=where)
    if transform == "auto":
        rows = wisconsin(rows, key=key, taxon=taxon, value=value)
    elif transform == "sqrt":
        rows = sqrt_transform(rows, value)
    return bray_curtis(rows, key=key, taxon=taxon, value=value)


def environment_fit(
    scores: DataFrame, environment: DataFrame, *, key: str, axes: tuple[str, str], variables: Sequence[str], factors: Sequence[str] = (),
    permutations: int = 1000,
) -> tuple[DataFrame, dict[str, DataFrame], dict[str, DataFrame]]:
    """Fit of environment variables and factors on ordination scores given as a table.

    Variables with R2, direction and p-value; centroids of each factor; R2 and p-value of each factor.
    """
    shared = [c for c in environment.columns if c in scores.columns and c != key]
    joined = scores.join(environment.drop(*shared), key, "left")
    vectors = env_fit_test(joined, key=key, axes=axes, variables=variables, permutations=permutations)
    centroids = {f: factor_fit(joined, axes=axes, factor=f) for f in factors}
    tests = {f: factor_fit_test(joined, key=key, axes=axes, factor=f, permutations=permutations) for f in factors}
    return vectors, centroids, tests
