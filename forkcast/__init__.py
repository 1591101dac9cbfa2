"""forkcast: venue analytics and modelling as lazy Spark DataFrame functions.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (or a
small fitted object such as a ``PipelineModel``) and is built from
built-in Spark SQL expressions, so Catalyst plans, prunes and distributes
the work.  Sub-packages:

``sources``    readers and writers (CSV, parquet, GeoJSON, metrics JSON, models)
``functions``  column expressions (text cleaning, list parsing, banding)
``operators``  DataFrame -> DataFrame operators (profile, clean, explore,
               geo, features, models, evaluation)
``plans``      end-to-end jobs (cleaning stage, feature stage, model stage,
               the whole DAG) and the query catalogue used by
               ``__spark_entry__``
``llm``        operators of a training-data pipeline; nothing else imports it
"""

__version__ = "0.1.0"
