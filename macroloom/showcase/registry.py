"""Registration of queries with their SQL."""

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    """Register ``fn(spark, table)`` under its own name; ``table(name)`` reads a driver table."""

    def register(fn):
        def run(spark, sf_dir):
            return fn(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__doc__ = fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register
