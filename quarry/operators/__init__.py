"""Operators: keyword ranking, postings and scores, k-means, clusters, diary."""

from quarry.operators import clusters, diary, keywords, kmeans, qa

__all__ = ["clusters", "diary", "keywords", "kmeans", "qa"]
