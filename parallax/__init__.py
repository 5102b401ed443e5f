"""Parallax: a PySpark-native engine that compares several readings of the same documents."""
