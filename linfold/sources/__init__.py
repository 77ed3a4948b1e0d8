from linfold.sources.catalog import create_namespace, drop_namespace, namespace_for
from linfold.sources.csv import read_csv, write_csv
from linfold.sources.models import load_model, save_model
from linfold.sources.preview import ordered_preview
from linfold.sources.tables import create_table, create_unlabeled_table, drop_table, read_table

__all__ = ["create_namespace", "drop_namespace", "namespace_for", "read_csv", "write_csv", "load_model",
           "save_model", "ordered_preview", "create_table", "create_unlabeled_table", "drop_table", "read_table"]
