"""Schemas of raw measurements and of the tables made from them."""

from __future__ import annotations

_QUERY = "struct<hostname:string,query_type:string,engine:string,failure:string,resolver_address:string,transaction_id:bigint,t:double,answers:array<struct<answer_type:string,ipv4:string,ipv6:string,hostname:string,as_org_name:string,asn:bigint,ttl:bigint>>>"
_TCP = "struct<ip:string,port:int,status:struct<success:boolean,failure:string>,transaction_id:bigint,t:double>"
_TLS = "struct<address:string,server_name:string,outer_server_name:string,echconfig:string,tls_version:string,cipher_suite:string,failure:string,no_tls_verify:boolean,peer_certificates:array<struct<format:string,data:string>>,transaction_id:bigint,t:double>"
_EVENT = "struct<operation:string,address:string,failure:string,proto:string,num_bytes:bigint,transaction_id:bigint,t:double>"
_REQUEST = "struct<network:string,address:string,alpn:string,failure:string,transaction_id:bigint,t:double,t0:double,request:struct<url:string,method:string,x_transport:string,body:string,headers_list:array<array<string>>,body_is_truncated:boolean>,response:struct<code:int,body:string,headers_list:array<array<string>>,body_is_truncated:boolean>>"
#: an ECH check has a handshake as its control
_CONTROL = "struct<" + _TLS[7:-1] + ",dns:struct<failure:string,addrs:array<string>>,tcp_connect:map<string,struct<status:boolean,failure:string>>,tls_handshake:map<string,struct<status:boolean,failure:string,server_name:string>>,http_request:struct<failure:string,body_length:bigint,title:string,status_code:int,headers:map<string,string>>>"

#: fields of a handshake
HANDSHAKE = ("address", "server_name", "outer_server_name", "echconfig", "tls_version", "cipher_suite", "failure", "no_tls_verify", "peer_certificates", "transaction_id", "t")

TEST_KEYS = (
    f"client_resolver string, blocking string, control_failure string, queries array<{_QUERY}>, tcp_connect array<{_TCP}>, "
    f"tls_handshakes array<{_TLS}>, network_events array<{_EVENT}>, requests array<{_REQUEST}>, control {_CONTROL}, "
    f"sent array<string>, received array<string>, failure string, target {_TLS}, "
    f"bootstrap struct<queries:array<{_QUERY}>>, lookups map<string,struct<queries:array<{_QUERY}>,tcp_connect:array<{_TCP}>,tls_handshakes:array<{_TLS}>,requests:array<{_REQUEST}>>>, "
    f"targets map<string,struct<queries:array<{_QUERY}>,tcp_connect:array<{_TCP}>,tls_handshakes:array<{_TLS}>,network_events:array<{_EVENT}>,requests:array<{_REQUEST}>>>"
)
#: as DDL text, so that the module loads without a session
MEASUREMENT = (
    "measurement_uid string, input string, report_id string, measurement_start_time string, test_start_time string, "
    "probe_asn string, probe_cc string, probe_id string, resolver_asn string, resolver_ip string, resolver_network_name string, "
    "probe_network_name string, test_name string, test_version string, software_name string, software_version string, "
    f"test_runtime double, annotations map<string,string>, test_keys struct<{TEST_KEYS}>, _corrupt_record string"
)
# The tests whose measurements are flattened.
TEST_NAMES = (
    "dnscheck", "signal", "facebook_messenger", "whatsapp", "telegram", "stunreachability", "tor", "browser_web", "urlgetter",
    "http_header_field_manipulation", "http_invalid_request_line", "web_connectivity", "echcheck",
)
