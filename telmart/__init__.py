"""Subscriber analytics for mobile operators, written as Spark jobs."""
