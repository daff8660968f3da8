"""Tables and topics that the operators read and write."""
