"""Inputs: JSON lines, JSON documents, spec tables, sessions, binary documents."""
