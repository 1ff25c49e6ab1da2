"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Conventions shared by all operators:

* the id column may be of any orderable type; ids may repeat and may be null (each docstring says what follows);
* a null text counts as an empty one unless a docstring says otherwise;
* internal columns start with ``_t_`` so that a caller's extra columns never clash;
* intermediate tables are written below ``spark.checkpoint.dir`` and survive lost executors.
"""
