"""Retail customer analytics on PySpark: cleaning, order history, RFM features,
snapshot training sets, churn and value models, and reporting datasets."""
