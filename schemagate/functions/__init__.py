"""Expressions as SQL text: nothing here touches a DataFrame or starts a job."""
