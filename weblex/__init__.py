"""weblex: term and domain analytics over web URL corpora, on Spark.

Main entry points:

* ``weblex.plans.jobs``: end-to-end jobs (``extract_hosts``,
  ``extract_urls``, ``normalize_domains``, ``term_frequency``, ``analyze``,
  ``first_seen_term_frequency``, ``sampled_term_frequency``);
* ``weblex.sources``: manifests and index files, line files, suffix rules;
* ``weblex.operators``: the DataFrame -> DataFrame operators they compose;
* ``weblex.streaming``: incremental counts and streaming normalization;
* ``python -m weblex``: the same jobs from the command line.
"""

__version__ = "0.1.0"
