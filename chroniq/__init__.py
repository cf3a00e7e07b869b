"""chroniq: integrity analytics over documents, logs and tables, as Spark plans."""

__version__ = "0.1.0"
