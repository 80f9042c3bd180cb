"""A layered sales warehouse written with the PySpark DataFrame API.

Raw catalogue, player and sale files are staged loosely typed, cleansed and
validated against dimensions and a calendar, repaired, tagged or quarantined,
monitored, and published as a star schema with analytical views and reports.

* ``functions`` - column expressions
* ``operators`` - DataFrame-to-DataFrame building blocks
* ``sources``   - readers and writers
* ``plans``     - the layers, views, reports and source preparation built on them
"""

from siltstone.rules import Rules

__all__ = ["Rules"]
