"""Spark-native analytics over scanned forms: manifests, ledgers, annotations, boxes, matching, redaction."""
