import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessella.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_docs(spark):
    """Documents from lists of texts; a text that starts with '@' is the address of an image."""

    def make(rows):
        data = [
            (
                doc_id,
                url,
                url.split("/")[2],
                warc,
                [("image", None, x[1:]) if x and x.startswith("@") else ("text", x, None) for x in nodes],
            )
            for doc_id, url, warc, nodes in rows
        ]
        return spark.createDataFrame(
            data,
            "doc_id long, url string, domain string, warc_filename string, "
            "nodes array<struct<kind string, text string, src string>>",
        )

    return make


@pytest.fixture
def bodies():
    """{doc_id: nodes in the notation of make_docs}"""

    def read(docs):
        return {
            r["doc_id"]: [n["text"] if n["text"] is not None else "@" + n["src"] for n in r["nodes"]]
            for r in docs.collect()
        }

    return read
