import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from plumbline.session import local_session

    shared = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    session = local_session("4", name="plumbline-tests", memory="6g", **shared)
    yield session
    session.stop()


@pytest.fixture(params=["text", "variant"])
def corpus_of(spark, request):
    """Shredded resources of hand-made documents: ``corpus_of({"a": [resource, ...]})``, in both forms of properties."""
    from plumbline.operators.templates import shred_resources, with_variant

    def build(documents, shred=True):
        rows = [(key, json.dumps({"resources": value})) for key, value in documents.items()]
        df = spark.createDataFrame(rows, "template_id STRING, template STRING")
        if not shred:
            return df
        return with_variant(shred_resources(df)) if request.param == "variant" else shred_resources(df)

    return build


def resource(kind, name, properties=None, depends_on=(), type_name=None):
    return {
        "name": f"[concat(parameters('factoryName'), '/{name}')]",
        "type": type_name or f"Microsoft.DataFactory/factories/{kind}",
        "apiVersion": "2018-06-01",
        "dependsOn": [f"[concat(variables('factoryId'), '/{d}')]" for d in depends_on],
        "properties": {} if properties is None else properties,
    }


def activity(name, *depends_on, **members):
    """``depends_on`` as (activity, condition) pairs."""
    return {
        "name": name,
        "type": "Copy",
        "dependsOn": [{"activity": a, "dependencyConditions": [c]} for a, c in depends_on],
        **members,
    }


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
