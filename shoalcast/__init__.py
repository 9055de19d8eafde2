"""Fisheries catch and value estimation as Spark jobs.

Every public function takes and returns ``DataFrame`` (or ``Column``) objects;
nothing here runs an engine of its own.  See README.md for the map from the
operator inventory to modules.
"""

__version__ = "0.1.0"
