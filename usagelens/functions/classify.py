"""Feature of an API call, by ordered rules on the action name.

Two classifiers exist and differ on purpose: the view's and the dataset's.
A rule is a label and the fragments that earn it; the first rule that matches
wins, so the order of a table is part of its meaning. Matching is
case-sensitive. ``Name*`` matches a prefix, ``*Name`` a suffix, anything else
a fragment.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: rule tables, in order --------------------------------------
VIEW_RULES = [
    ("Automation", ["Automation", "Deployment"]),
    ("Connector", ["ActionConnector", "PassAction"]),
    ("Workflow", ["Workflow"]),
    ("Research", ["Research"]),
    ("Chat", ["Assistant", "Chat", "Conversation"]),
    ("Integration", ["Integration"]),
    ("Dashboard", ["Dashboard"]),
    ("Analysis", ["Analysis", "Analys"]),
    ("Dataset", ["DataSet", "Dataset"]),
    ("Data Source", ["DataSource"]),
    ("Ingestion", ["Ingestion", "Refresh"]),
    ("Q Topic", ["Topic"]),
    ("Space", ["Space", "Namespace"]),
    ("Knowledge Base", ["KnowledgeBase", "Knowledge"]),
    ("Flow", ["Flow"]),
    ("Folder", ["Folder"]),
    ("Template", ["Template"]),
    ("Theme", ["Theme"]),
    ("User & Access", ["User", "Group", "Membership"]),
    ("Embedding", ["Embed"]),
    ("Account Settings", ["Account", "Setting"]),
    ("Authorization", ["Authorization"]),
    ("Search", ["Search"]),
]
VIEW_FALLBACK = "Other"

DATASET_RULES = [
    ("Automation", ["Automation", "Deployment"]),
    ("Connector", ["PassAction"]),
    ("Workflow", ["Workflow"]),
    ("Research", ["Research"]),
    ("Dashboard", ["Dashboard"]),
    ("Analysis", ["Analysis", "Analys"]),
    ("Dataset", ["DataSet", "Dataset"]),
    ("Data Source", ["DataSource"]),
    ("Ingestion", ["Ingestion", "Refresh"]),
    ("Topic", ["Topic"]),
    ("Space", ["*Space"]),
    ("Knowledgebase", ["KnowledgeBase", "Knowledge"]),
    ("Folder", ["Folder"]),
    ("Template", ["Template"]),
    ("Theme", ["Theme"]),
    ("Embedding", ["Embed"]),
    ("Authorization", ["Authorization"]),
    ("Search", ["Search*"]),
    ("Database", ["Database"]),
]
# In the dataset's table this rule does not apply to names with this prefix.
DATASET_EXCEPT = {"Automation": "Search*"}
# --- end of fixed values ------------------------------------------------------

Rules = list[tuple[str, list[str]]]


def _matches(name: Column, fragment: str) -> Column:
    if fragment.startswith("*"):
        return name.endswith(fragment[1:])
    if fragment.endswith("*"):
        return name.startswith(fragment[:-1])
    return name.contains(fragment)


def _first_match(name: Column, rules: Rules, excepted: dict[str, str]) -> Column:
    arms = []
    for label, fragments in rules:
        hit = reduce(Column.__or__, [_matches(name, f) for f in fragments])
        if label in excepted:
            hit = hit & ~_matches(name, excepted[label])
        arms.append((hit, label))
    chain = F.when(*arms[0])
    for hit, label in arms[1:]:
        chain = chain.when(hit, label)
    return chain


def view_feature(event_name: Column) -> Column:
    return _first_match(event_name, VIEW_RULES, {}).otherwise(VIEW_FALLBACK)


def dataset_feature(event_name: Column) -> Column:
    return _first_match(event_name, DATASET_RULES, DATASET_EXCEPT).otherwise(event_name)
