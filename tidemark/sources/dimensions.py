"""The three dimensions: fixed values, and their DataFrames."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.bands import Band
from tidemark.schemas import POLARITY_CATEGORIES, TRACKED_PROJECTS, TRACKED_SUBREDDITS


@dataclass(frozen=True)
class Project:
    """A tracked tool: display name, terms that mention it, its package if it
    has one, its categories."""

    name: str
    terms: tuple[str, ...]
    package: str | None = None
    categories: tuple[str, ...] = ()


# --- fixed values ------------------------------------------------------------

BANDS = (
    Band("Very Negative", 1, -1.0, -0.6),
    Band("Negative", 2, -0.599, -0.2),
    Band("Neutral", 3, -0.199, 0.199),
    Band("Positive", 4, 0.2, 0.599),
    Band("Very Positive", 5, 0.6, 1.0),
)

SUBREDDITS = (
    "dataengineering",
    "MachineLearning",
    "datascience",
    "analytics",
    "LocalLLaMA",
    "learnprogramming",
)

# Name, search terms, package, categories. The order is that of the mention
# lists; the leading blanks in some categories are part of the values.
TRACKED = (
    Project("Delta Lake", ("Delta Lake", "Delta Table", "Delta Format"), "deltalake", ("Open Table Format",)),
    Project("Apache Iceberg", ("Iceberg",), "pyiceberg", ("Open Table Format",)),
    Project("Apache Hudi", ("Hudi",), "hudi", ("Open Table Format",)),
    Project("Apache Avro", ("Avro",), "avro", ("Serialization Format", "File Format")),
    Project("Apache Arrow", ("Arrow", "PyArrow"), "pyarrow", ("Serialization Format",)),
    Project("Apache Parquet", ("Parquet",), None, ("File Format",)),
    Project("Apache ORC", ("ORC",), "pyorc", ("File Format",)),
    Project("Apache Thrift", ("Thrift",), "thrift", ("Data Protocol",)),
    Project("Protobuf", ("Protobuf", "Protocol Buffers"), "protobuf", ("Serialization Format", "Data Protocol")),
    Project("Apache Kafka", ("Kafka",), "kafka", ("Streaming Framework", "Data Storage")),
    Project("Apache Flink", ("Flink",), "apache-flink", ("Streaming Framework", "Data Processing Engine")),
    Project("Confluent Kafka", ("Confluent",), "confluent-kafka", ("Streaming Platform", "Data Processing Platform")),
    Project("Redpanda", ("Redpanda",), None, ("Streaming Platform", "Data Processing Platform")),
    Project("Striim", ("Striim",), None, ("Streaming Platform", "Data Processing Platform")),
    Project("PostgreSQL", ("Postgres",), "psycopg2", ("Relational Database", " Data Storage")),
    Project("MySQL", ("MySQL",), "mysql-connector-python", ("Relational Database", " Data Storage")),
    Project("SQLServer", ("SQL Server",), None, ("Relational Database", " Data Storage")),
    Project("SQLite", ("SQLite",), None, ("Relational Database", " Data Storage")),
    Project("DynamoDB", ("Dynamo DB",), None, ("NoSQL Database", "Data Storage")),
    Project("MongoDB", ("Mongo DB",), "pymongo", ("NoSQL Database", "Data Storage")),
    Project("CosmosDB", ("Cosmos DB",), None, ("NoSQL Database", "Graph Database", "Data Storage")),
    Project("ScyllaDB", ("Scylla DB",), "scylla-driver", ("NoSQL Database", "Data Storage")),
    Project("Apache Druid", ("Druid",), "pydruid", ("OLAP Database", "Data Storage")),
    Project("ClickHouse", ("ClickHouse",), "clickhouse-connect", ("OLAP Database", "Data Storage")),
    Project("Apache Pinot", ("Pinot",), "pinotdb", ("OLAP Database", "Data Storage")),
    Project("DuckDB", ("Duck DB",), "duckdb", ("OLAP Database", "Data Processing Engine")),
    Project("Amazon Redshift", ("Redshift",), None, ("Data Warehouse", "Data Storage")),
    Project("Google BigQuery", ("BigQuery",), "google-cloud-bigquery", ("Data Warehouse", "Data Storage")),
    Project("Azure Synapse Analytics", ("Synapse",), None, ("Data Warehouse", "Analytics Platform")),
    Project("Databricks", ("Databricks",), None, ("Data Warehouse", "Analytics Platform")),
    Project("Snowflake", ("Snowflake",), None, ("Data Warehouse", "Analytics Platform")),
    Project("Dremio", ("Dremio",), None, ("Data Warehouse", "Analytics Platform")),
    Project("Starburst", ("Starburst",), None, ("Data Warehouse", "Analytics Platform")),
    Project("Microsoft Fabric", ("Microsoft Fabric", "MS Fabric"), None, ("Data Warehouse", "Analytics Platform")),
    Project("Couchbase", ("Couchbase",), "couchbase", ("NoSQL Database", "Data Storage")),
    Project("CockroachDB", ("Cockroach DB",), None, ("Relational Database", " Data Storage")),
    Project("MariaDB", ("Maria DB",), "mariadb", ("Relational Database", " Data Storage")),
    Project("Apache Cassandra", ("Cassandra",), None, ("NoSQL Database", "Data Storage")),
    Project("Redis", ("Redis",), "redis", ("In-Memory Database",)),
    Project("Neptune", ("Neptune",), "neptune", ("Graph Database", "Data Storage")),
    Project("Neo4j", ("Neo 4j",), "neo4j", ("Graph Database", "Data Storage")),
    Project("JanusGraph", ("Janus Graph",), None, ("Graph Database", "Data Storage")),
    Project("ArangoDB", ("Arango DB",), "pyarango", ("Graph Database", "Data Storage")),
    Project("Pinecone", ("Pinecone",), "pinecone", ("Vector Database", "Data Storage")),
    Project("Weaviate", ("Weaviate",), "weaviate-client", ("Vector Database", "Data Storage")),
    Project("Qdrant", ("Qdrant",), "qdrant-client", ("Vector Database", "Data Storage")),
    Project("Chroma", ("Chroma",), "chromadb", ("Vector Database", "Data Storage")),
    Project("TimescaleDB", ("Timescale DB",), None, ("Time Series Database", "Data Storage")),
    Project("InfluxDB", ("Influx DB",), "influxdb-client", ("Time Series Database", "Data Storage")),
    Project("Apache Spark", ("Spark",), "pyspark", ("Data Processing Engine",)),
    Project("Trino", ("Trino",), "trino", ("Data Processing Engine",)),
    Project("Presto", ("Presto",), "presto-python-client", ("Data Processing Engine",)),
    Project("dbt Labs", ("dbt",), "dbt-core", ("Data Transformation Framework",)),
    Project("SDF Labs", ("SDF",), "sdf-cli", ("Data Transformation Framework", "Data Processing Engine")),
    Project("Fivetran", ("Fivetran",), None, ("Data Integration Engine", "Data Integration Platform")),
    Project("Airbyte", ("Airbyte",), "airbyte", ("Data Integration Engine", "Data Integration Platform")),
    Project("Meltano", ("Meltano",), "meltano", ("Data Integration Engine",)),
    Project("AWS Glue", ("Glue",), None, ("Data Integration Platform", "Data Processing Platform")),
    Project("Azure Data Factory", ("Data Factory", "ADF"), None, ("Data Integration Platform", "Data Processing Platform")),
    Project("Google Cloud Dataflow", ("Dataflow",), None, ("Data Integration Platform", "Data Processing Platform")),
    Project("Apache Airflow", ("Airflow",), "apache-airflow", ("Orchestration Engine",)),
    Project("Dagster", ("Dagster",), "dagster", ("Orchestration Engine",)),
    Project("Prefect", ("Prefect",), "prefect", ("Orchestration Engine",)),
    Project("Mage", ("Mage",), "mage-ai", ("Data Integration Engine", "Orchestration Engine")),
    Project("Astronomer", ("Astronomer",), None, ("Orchestration Platform",)),
    Project("Collibra", ("Collibra",), "collibra-core", ("Data Catalog", "Data Governance")),
    Project("Monte Carlo", ("Monte Carlo Data", "MonteCarlo"), None, ("Data Governance",)),
    Project("Soda", ("Soda",), "soda-core", ("Data Governance",)),
    Project("Microsoft Purview", ("Purview",), None, ("Data Governance",)),
    Project("Pandas", ("Pandas",), "pandas", ("Data Processing Engine", "Data Frame API")),
    Project("Polars", ("Polars",), "polars", ("Data Processing Engine", "Data Frame API")),
    Project("Ibis", ("Ibis",), "ibis-framework", ("Data Processing Engine", "Data Frame API")),
    Project("PyTorch", ("PyTorch",), "torch", ("Machine Learning Framework",)),
    Project("TensorFlow", ("TensorFlow",), "tensorflow", ("Machine Learning Framework",)),
    Project("Keras", ("Keras",), "keras", ("Machine Learning Framework",)),
    Project("Scikit-Learn", ("Scikit Learn", "SKLearn"), "scikit-learn", ("Machine Learning Framework",)),
    Project("XGBoost", ("XGBoost",), "xgboost", ("Gradient Boosting Algorithm",)),
    Project("LightGBM", ("LightGBM",), "lightgbm", ("Gradient Boosting Algorithm",)),
    Project("Google Vertex AI", ("Vertex",), None, ("Machine Learning Platform",)),
    Project("Amazon Sagemaker", ("Sagemaker",), None, ("Machine Learning Platform",)),
    Project("Azure Machine Learning", ("Azure Machine Learning", "Azure ML"), None, ("Machine Learning Platform",)),
    Project("MLFlow", ("ML Flow",), "mlflow", ("MLOps Framework",)),
    Project("Optuna", ("Optuna",), "optuna", ("MLOps Framework",)),
    Project("Weights & Biases", ("Weights & Biases", "Weights and Biases", "wandb"), "wandb", ("MLOps Framework",)),
    Project("dvc", ("dvc",), "dvc", ("MLOps Framework",)),
    Project("Kubeflow", ("Kubeflow",), "kfp", ("MLOps Framework",)),
    Project("ZenML", ("Zen ML",), "zenml", ("MLOps Framework",)),
    Project("LangChain", ("LangChain",), "langchain", ("LLM Integration Framework",)),
    Project("LlamaIndex", ("Llama Index",), "llama-index", ("LLM Integration Framework",)),
    Project("DSPy", ("DSPy",), "dspy-ai", ("LLM Prompt Optimization Framework",)),
    Project("LiteLLM", ("LiteLLM",), "litellm", ("LLM Serving Engine",)),
    Project("LMQL", ("LMQL",), "lmql", ("LLM Prompt Optimization Framework",)),
    Project("Haystack", ("Haystack",), "haystack-ai", ("LLM Integration Framework",)),
    Project("Ollama", ("Ollama",), "ollama", ("LLM Serving Engine",)),
    Project("LlamaCpp", ("Llama Cpp",), "llama-cpp-python", ("LLM Serving Engine",)),
    Project("OpenLLM", ("OpenLLM",), "openllm", ("LLM Serving Engine",)),
    Project("AdalFlow", ("AdalFlow",), "adalflow", ("LLM Prompt Optimization Framework",)),
    Project("vLLM", ("vLLM",), "vllm", ("LLM Serving Engine",)),
    Project("LitServe", ("LitServe",), "litserve", ("LLM Serving Engine",)),
    Project("Tableau", ("Tableau",), None, ("Dashboard and BI Platform",)),
    Project("Microsoft PowerBI", ("PowerBI",), None, ("Dashboard and BI Platform",)),
    Project("Looker", ("Looker",), None, ("Dashboard and BI Platform",)),
    Project("Amazon QuickSight", ("QuickSight",), None, ("Dashboard and BI Platform",)),
    Project("Apache Superset", ("Superset",), None, ("Dashboard and BI Platform",)),
    Project("Evidence.dev", ("Evidence.dev",), None, ("Dashboard and BI Platform",)),
    Project("Airtable", ("Airtable",), None, ("Dashboard and BI Platform",)),
    Project("Microsoft Excel", ("Excel",), None, ("Spreadsheets Application",)),
    Project("Google Sheets", ("Google Sheets",), None, ("Spreadsheets Application",)),
    Project("Unity Catalog", ("Unity Catalog",), None, ("Data Catalog",)),
    Project("Polaris Catalog", ("Polaris",), None, ("Data Catalog",)),
    Project("Nessie Catalog", ("Nessie",), None, ("Data Catalog",)),
    Project("Hive Metastore", ("Hive Metastore",), None, ("Data Catalog",)),
    Project("AWS Glue Catalog", ("Glue Catalog",), None, ("Data Catalog",)),
)

# --- DataFrames --------------------------------------------------------------


def projects_from_json(text: str) -> list[Project]:
    """The tracked projects as the mentions job takes them: a JSON list of
    objects with name, search terms, package and categories."""
    return [
        Project(
            item["project_name"],
            tuple(item["project_search_terms"]),
            item.get("pypi"),
            tuple(item.get("project_categories", ())),
        )
        for item in json.loads(text)
    ]


def project_rows(spark: SparkSession, projects: Sequence[Project] = TRACKED) -> DataFrame:
    rows = [(p.name, list(p.terms), p.package, list(p.categories)) for p in projects]
    return spark.createDataFrame(rows, TRACKED_PROJECTS.schema)


def band_rows(spark: SparkSession, bands: Sequence[Band] = BANDS) -> DataFrame:
    rows = [(b.category, b.order, b.lower, b.upper) for b in bands]
    return spark.createDataFrame(rows, POLARITY_CATEGORIES.schema)


def subreddit_rows(spark: SparkSession, names: Iterable[str] = SUBREDDITS) -> DataFrame:
    named = spark.createDataFrame([(n,) for n in names], "subreddit_name string")
    return with_subreddit_url(named)


def with_subreddit_url(named: DataFrame) -> DataFrame:
    url = F.concat(F.lit("https://reddit.com/r/"), F.lower(F.col("subreddit_name")))
    return named.withColumn("subreddit_url", url).select(*TRACKED_SUBREDDITS.schema.names)


def package_names(projects: DataFrame) -> DataFrame:
    """The distinct packages of the dimension; projects without one drop out."""
    return (
        projects.where(F.col("pypi_project_name").isNotNull())
        .select(F.col("pypi_project_name").alias("project"))
        .distinct()
    )
