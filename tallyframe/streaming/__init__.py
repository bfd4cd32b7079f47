"""Monitoring of request streams, batch and streaming."""
