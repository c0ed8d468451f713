"""Daily retail demand analytics on Spark.

Layers, bottom up: ``sources`` (files, JDBC, the star-schema adapter),
``functions`` (column expressions), ``operators`` (DataFrame -> DataFrame),
``models`` (per-series and pooled learners), ``store`` (versioned forecasts,
actuals and runs) and ``plans`` (the ETL and backtest pipelines).
"""
