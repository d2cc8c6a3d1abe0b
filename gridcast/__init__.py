"""gridcast: Spark operators for cleaning, featurising, forecasting and monitoring many time series at once."""
