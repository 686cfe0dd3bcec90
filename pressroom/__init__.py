"""Pressroom: collect, store and classify short articles with Spark DataFrames."""
