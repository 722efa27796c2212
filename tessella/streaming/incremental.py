"""New page files to documents, each file once.

The page flow is one narrow stage, so it runs unchanged on a file stream; the
checkpoint of the stream remembers which files are done, and a failed run resumes.
"""

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessella.plans.flows import pages_to_documents

PAGES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("warc_filename", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)


def extract_new_pages(
    spark: SparkSession, pages_path: str, documents_path: str, checkpoint_path: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Process the page files that have arrived since the last run, then stop."""
    pages = (
        spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(pages_path)
    )
    return (
        pages_to_documents(pages)
        .writeStream.format("parquet")
        .option("path", documents_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
