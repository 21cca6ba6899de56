"""Reference SQL the Spark results are checked against."""
