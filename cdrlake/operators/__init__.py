"""DataFrame to DataFrame operators: quality, Silver, Gold, views, measures, churn."""
